"""Personal data, licenses, language, packing and web pages against plain versions."""

import hashlib
import html
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tickshard.llm.scratch import Scratch
from tickshard.llm import language, licenses, packing, pii, template
from tickshard.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
TEXT = "doc_id bigint, text string"
#: NULL, empty and long texts, ties and repeated rows.
EDGES = [(1, None), (2, ""), (3, " \t\n"), (None, "a b c"), (4, "x " * 30000), (5, "one"), (5, "one")]


def documents(spark):
    """Real documents with ids that those made in tests don't have."""
    return spark.read.parquet(f"{SF}/documents.parquet").withColumn("doc_id", F.expr("doc_id + 5000"))


# -- personal data -----------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if max(map(int, m[0].split("."))) <= 255]
    for m in CARD.finditer(text):
        d = digits(m[0])
        doubled = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and doubled % 10 == 0:
            found.append((2, *m.span()))
    return found + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


def test_base_spans_of_random_texts():
    rng = random.Random(11)
    parts = ["a", "@", ".", "b-", "1", "22", "300", "+", " ", "(", ")", "4111111111111111", "-",
             "_", "é", "\n", "a@b.c", "1.2.3.4", "+1 (22) 333-4444", "0" * 25]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        assert pii.base_spans(text) == plain_spans(text), text
    for hard in ("1" * 300000, "a" * 300000 + "@", "1." * 99999, "+1" * 99999, "@a." * 99999):
        assert len(pii.base_spans(hard)) <= len(hard) // 8  # and takes no long time


def test_spans_of_documents(spark, frame):
    docs = documents(spark)
    field = pii.train(docs)
    extra = frame([(10, "mail a.b@c.de +1 (22) 333-4444 4111111111111111 end"), *EDGES], TEXT)
    texts = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    texts |= {(r.doc_id, r.text) for r in extra.collect()}
    found = pii.find(docs.select("doc_id", "text").unionByName(extra), field).collect()
    assert len(found) == docs.count() + 1 + len(EDGES)
    by_id = {d: t or "" for d, t in texts if d is not None}
    for r in found:
        if r.doc_id is None:
            continue
        base = plain_spans(by_id[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, *_ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(pii.listed(base).encode()).hexdigest()
        assert set(pii.listed(base).split(",")) <= set(r.spans.split(","))
    joined = next(r for r in found if r.doc_id == 10)  # the pattern for phones runs into the card
    assert joined.n_phone == 0 and "card:31:47" in joined.spans and "phone:14:30" in joined.spans


def test_masking_keeps_columns_and_clean_texts(frame):
    rows = [(1, "a@b.cd x", "en", 8, "k"), (2, "clean", None, 5, None), (3, None, "de", None, "k")]
    docs = frame(rows, "doc_id bigint, text string, lang string, n_chars bigint, spans string")
    masked = pii.mask(docs, pii.Field())
    assert masked.schema == docs.schema
    assert [tuple(r) for r in masked.collect()] == [(1, "[EMAIL] x", "en", 9, "k"), *rows[1:]]
    assert pii.train(docs.limit(0)).weights == {}


def test_sample_holds_different_windows_of_every_kind(frame):
    # copies of one window must not take the places of others
    rows = [(i, "page 7 of 9") for i in range(4000)] + [(9000 + i, f"row {i} end") for i in range(3000)]
    rows += [(1, "a@b.cd"), (2, "ip 1.2.3.4"), (3, "no 4111111111111111"), (4, "+1 22 333 4444")]
    sample = pii.sample_windows(frame(rows, TEXT))
    assert len(sample) == len(set(sample)) == pii.SAMPLE
    assert {k for w in sample for k, _, _ in pii.base_spans(w)} == {0, 1, 2, 3}


def test_windows_are_whole_words_without_a_limit(spark):
    lines = "".join(f"\n{i}.\t+49 (0) 89-{i:07d}" for i in range(2000))
    assert pii.windows(lines) == [(1, len(lines))]
    glued = "-".join(["1234567"] * 500)
    assert pii.windows(f"a b c {glued} d e f") == [(2, len(glued) + 10)]
    assert all(len(w) <= pii.WINDOW for w in pii.short_windows(lines + " " + glued))
    assert " ".join(pii.short_windows(lines)).split() == lines.split()


def test_bracketed_at_is_found():
    field = pii.Field().fit([f"mail {a}.{b}@{c}.org now 1{i}" for i, (a, b, c) in enumerate(
        [("jo", "smith", "web"), ("ann", "lee", "host"), ("bo", "li", "box")] * 20)])
    text = "mail john.doe [at] mail [dot] org now"
    assert (0, 5, 33) in field.spans(text)[1] and text[5:33].endswith("org")


# -- licenses ----------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def test_base_phrases(spark, frame):
    texts = ["MIT License, mit-license", "mit  licenses", "GNU General Public License\nApache LICENSE",
             "émit license", "the general public", None, "", "license mit license mit license"]
    docs = documents(spark).select("doc_id", "text").unionByName(
        frame([(1000 + i, t) for i, t in enumerate(texts)], TEXT))
    by_id = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in licenses.scan_licenses(docs).collect():
        words = WORD.findall(licenses.lowered(by_id[r.doc_id]))
        places, labels = [], set()
        for phrase, label in licenses.BASE.items():
            own = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(own)] == own]
            places += at
            labels |= {label} if at else set()
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert r.base_labels == ",".join(sorted(labels)) and labels <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert licenses.scan_licenses(frame([], TEXT)).count() == 0


def expanded(template):
    """All wordings of a template without replaceable regions, by plain expansion."""
    m = re.search(r"<<optional>>((?:(?!<</?optional>>).)*)<</optional>>", template)
    if not m:
        return {tuple(WORD.findall(template))}
    return expanded(template[: m.start()] + m[1] + template[m.end() :]) | expanded(
        template[: m.start()] + " " + template[m.end() :])


def test_automata_accept_what_expansion_gives():
    text = "a <<optional>>b <<optional>>c<</optional>><</optional>> d <<optional>>e<</optional>>"
    automaton, wordings = licenses.compile_template(text), expanded(text)
    rng = random.Random(1)
    for _ in range(3000):
        words = [rng.choice("abcde") for _ in range(rng.randrange(1, 8))]
        ends = [n for n in range(1, len(words) + 1) if tuple(words[:n]) in wordings]
        assert automaton.match(words, 0) == max(ends, default=-1)
    replaced = licenses.compile_template('copyright <<var match="[a-z]+( [a-z]+)?">> end')
    assert replaced.match("copyright of me end".split(), 0) == 4
    assert replaced.match("copyright of all me end".split(), 0) == -1
    assert replaced.match("copyright 1 end".split(), 0) == -1


def filled(template, *regions):
    """A wording of a template: without optional words, with *regions* in the replaceable ones."""
    text = re.sub("<<optional>>.*?<</optional>>", "", template)
    for region in regions:
        text = re.sub('<<var match="[^"]*">>', region, text, count=1)
    return text


LONG = {  # the whole licenses, and what stands in their regions
    "mit": ["this software", "the authors"], "isc": ["the author", "the author"],
    "bsd-2-clause": ["the holders", "the owner"], "bsd-3-clause": ["acme", "its contributors", "them", "us"],
}


@pytest.mark.parametrize("label", LONG)
def test_whole_licenses(label):
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.BASE)
    template = max(licenses.TEMPLATES[label], key=len)
    words = filled(template, *LONG[label]).split()
    labels = lambda ws: {found for _, _, found in scanner.scan(ws)[1]}
    assert labels(words) == {label} and labels(["x"] * 5 + words + ["y"] * 5) == {label}
    long = filled(template, " ".join(["name"] * 500), *LONG[label][1:]).split()
    assert labels(long) == {label}
    mandatory = [i for i, w in enumerate(words) if w in licenses.compile_template(template).mandatory]
    regions = {w for r in LONG[label] for w in r.split()}
    for i in mandatory:
        if words[i] not in regions:
            assert labels(words[:i] + ["nonsense"] + words[i + 1 :]) == set()
    for part in (words[:20], words[:-1], words[1:], words[: len(words) // 2]):
        assert labels(part) == set()
    assert labels(words * 2) == {label} and len(scanner.scan(words * 3)[1]) == 3


def test_replaceable_regions_of_any_length():
    made = licenses.compile_template('copy of <<var match=".+">> and <<optional>>the<</optional>> files')
    for n in (1, 12, 13, 500):
        assert made.match(["copy", "of", *["x"] * n, "and", "files", "z"], 0) == n + 4
        assert made.match(["copy", "of", *["and"] * n, "and", "the", "files"], 0) == n + 5
    assert made.match("copy of and files".split(), 0) == -1
    hopeless = set()
    assert made.match(["copy", "of", "x", "copy", "of", "y"], 0, hopeless) == -1 and hopeless
    listed = licenses.compile_template('by <<var match="[a-z]+( [a-z]+)*">> in <<var match="[0-9]{4}">>')
    assert listed.match(["by", *["x"] * 40, "in", "1999"], 0) == 43
    assert listed.match("by x 7 in 1999".split(), 0) == -1


def test_license_notices(frame):
    texts = ["Licensed under CC BY-NC 4.0.", "Licensed under the Apache License, Version 2.0.",
             "This work is licensed under the GNU General Public License, version 3 or later",
             "a license is not enough", "licensed under the mit"]
    found = licenses.scan_licenses(frame(list(enumerate(texts)), TEXT)).orderBy("doc_id").collect()
    assert [r.labels for r in found] == ["cc-by-nc", "apache", "gpl", "", ""]


# -- language ----------------------------------------------------------------------


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = language.held_out()
    model = language.train(docs.where(~held))
    found = language.identify(docs.where(held), model).collect()
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.97
    assert all(0 <= r.score <= 1 for r in found)
    ids = {r.doc_id for r in found}
    assert ids == {r.doc_id for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}


def test_numerals_are_no_letters():
    assert not any(map(language.has_letter, [None, "", "12 ½ ² Ⅷ _"]))
    assert all(map(language.has_letter, ["½ a", "é", "語"]))


def test_scores_are_those_of_plain_naive_bayes(frame):
    rows = [(1, "aab", "x"), (2, "bba", "y"), (3, "bbb b", "y")]
    docs = frame(rows, f"{TEXT}, lang string")
    model = language.train(docs)
    counts = {}
    for _, text, lang in rows:
        code, _ = language.grams([text])
        own = counts.setdefault(lang, {})
        for c in code.tolist():
            own[c] = own.get(c, 0) + 1
    code, _ = language.grams(["ab"])
    odds = {}
    for lang, own in counts.items():
        p = [r[2] for r in rows].count(lang) / 3
        total = sum(own.values()) + language.SMOOTHING * language.BUCKETS
        for c in code.tolist():
            p *= (own.get(c, 0) + language.SMOOTHING) / total
        odds[lang] = p
    names, scores = model.predict(["ab"])
    assert names == [max(odds, key=odds.get)]
    assert abs(scores[0] - max(odds.values()) / sum(odds.values())) < 1e-4


def test_language_edges(frame):
    docs = frame([*EDGES, (9, "12 34 %%")], TEXT).selectExpr("*", "'k' lang_pred", "1 AS score")
    learned = frame([("abc", "en"), ("xyz", "fr"), (None, "de"), ("abc", None)], "text string, lang string")
    found = language.identify(docs, language.train(learned)).collect()
    assert [(r.doc_id, r.lang_pred) for r in found if r.doc_id in (1, 2, 3, 9)] == [
        (1, "und"), (2, "und"), (3, "und"), (9, "und")]
    nothing = language.train(learned.limit(0))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(docs.limit(0), nothing).count() == 0


# -- packing -----------------------------------------------------------------------


def test_round_trip(spark, frame):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    hard = ["a  b", "\n a", "x \ty", "it's don't 'S", "<|endoftext|> a b", "é1２3 ٣4", "a\x1c b",
            "\x85 b c", "a​b c", "日本 語 12ab_c", " ", "x\r\n y", "a b\n", "﻿ a b", "a\xa0 b"]
    rows = [*EDGES, *((100 + i, t) for i, t in enumerate(hard))]
    docs = documents(spark).select("doc_id", "text")
    docs = docs.unionByName(frame(rows, TEXT))
    pieces = packing.pack(docs, tokenizer_path(), with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in p.ids))
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for r in docs.where("doc_id IS NOT NULL AND doc_id <> 5").collect():
        own = sorted(by_doc[r.doc_id], key=lambda p: p.start)
        ids = whole.encode(r.text or "", add_special_tokens=False).ids + [0]
        assert [i for p in own for i in p.ids] == ids and {p.doc_tokens for p in own} == {len(ids)}
        assert [p.start for p in own] == [sum(len(q.ids) for q in own[:i]) for i in range(len(own))]
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert len(by_doc[5]) == 2 and len(by_doc[None]) == 1
    used = sum(p.length for p in pieces)
    assert len(by_sequence) <= used / 1024 * 1.02 + 1
    assert packing.pack(frame([], TEXT), tokenizer_path()).count() == 0


def test_packed_pieces_hold_their_ids(spark, frame):
    import corpus_pipeline

    docs = frame([(1, "a b c"), (2, None), (3, "word " * 3000)], TEXT)
    rows = corpus_pipeline.packed(spark, docs, SF).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3}
    for r in rows:
        assert len(r.ids) == r.length
        assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids))


def test_chunks_that_mirror_each_other_have_their_own_ids(frame):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    texts = [f"x {one} {two}", f"{two} {one}", f"{one}", f" {two}", "x"]
    rows = packing.pack(frame(list(enumerate(texts)), TEXT), tokenizer_path(), 512).collect()
    for i, text in enumerate(texts):
        own = sorted((r.start, r.ids) for r in rows if r.doc_id == i)
        assert [t for _, ids in own for t in ids] == whole.encode(text, add_special_tokens=False).ids + [0]


def test_many_pieces_of_one_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "CELL", 500)
    docs = spark.range(100_000).selectExpr("id AS doc_id", "'a b c' AS text")
    rows = packing.pack(docs, tokenizer_path(), window=10).drop("ids")
    spread = rows.groupBy("sequence_id").count().groupBy("count").count().collect()
    assert [tuple(r) for r in spread] == [(2, 50_000)]
    assert rows.select("sequence_id", "offset").distinct().count() == 100_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = rows.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) == 4 and max(r["count"] for r in tasks) < 40_000


def test_fill_is_the_best_subset_sum():
    rng = random.Random(4)
    for _ in range(300):
        room = rng.randrange(1, 40)
        counts = [0] + [rng.choice([0, 0, 1, 3]) for _ in range(20)]
        best = {0}
        for n, c in enumerate(counts):
            best = {s + n * k for s in best for k in range(c + 1) if s + n * k <= room}
        chosen = packing.fill(room, counts)
        assert sum(n * k for n, k in chosen.items()) == max(best)
        assert all(k <= counts[n] for n, k in chosen.items())


# -- web pages ---------------------------------------------------------------------


def test_articles_of_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r for r in template.extract_main_text(pages).collect()}
    assert len(found) == pages.count()
    for r in pages.collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split())
                  for b in re.split("</?(?:p|h1)>", article)]
        assert found[r.page_id].text == "\n".join(b for b in blocks if b)
        assert found[r.page_id].n_chars == len(found[r.page_id].text)


def test_template_strings_and_regions_go(frame):
    page = (
        "<html><head><title>T</title><style>p{{}}</style></head><body><div class='top'>Our Site</div>"
        "<div id=nav><a>Home</a></div><div class=x><p>Text {0} &amp; more</p><p>Other\n {0}</p></div>"
        "<div class='cookie-notice'>We use cookies</div><div>All rights reserved</div>"
        "<div class='comments'><p>nice {0}</p></div><script>var a='</p>'</script></body></html>"
    )
    rows = [(i, f"https://h.org/{i}", page.format(i)) for i in range(5)]
    rows += [(7, None, None), (8, "https://one.org/", "<p>lone"), (9, "x", ""), (None, "https://h.org/", "<p>a&lt;b<br>c")]
    schema = "page_id bigint, url string, html string"
    found = {r.page_id: r.text for r in template.extract_main_text(frame(rows, schema)).collect()}
    assert found == {**{i: f"Text {i} & more\nOther {i}" for i in range(5)},
                     7: "", 8: "lone", 9: "", None: "a<b c"}
    assert template.extract_main_text(frame([], schema)).count() == 0


PAGE_SCHEMA = "page_id bigint, url string, html string"


def texts_of(frame, *pages, host="h.org"):
    rows = [(i, f"https://{host}/{i}", p) for i, p in enumerate(pages)]
    found = template.extract_main_text(frame(rows, PAGE_SCHEMA).repartition(3)).collect()
    return [r.text for r in sorted(found, key=lambda r: r.page_id)]


def strange(n, links=3):
    """A page without article tags whose class names say nothing."""
    menu = "".join(f"<li><a href=/{n}{i}>go {n} {i}</a></li>" for i in range(links))
    return (f"<html><body><div class=q1>The Site</div><ul class=q2>{menu}</ul><div class=q3><h1>Head {n}</h1>"
            f"<p>First {n} of all that is said here today</p><p>Said <a href=/x>the {n} of long link text</a></p></div>"
            f"<div class=q4>All rights reserved</div></body></html>")


def test_templates_decide_where_names_do_not(frame, monkeypatch):
    pages = [strange(n, 2 + n % 3) for n in range(6)]
    wanted = [f"Head {n}\nFirst {n} of all that is said here today\nSaid the {n} of long link text" for n in range(6)]
    assert texts_of(frame, *pages) == wanted
    # copies of a page are one page, and two different pages are enough
    assert texts_of(frame, pages[0], pages[0], pages[1]) == [wanted[0], wanted[0], wanted[1]]
    assert texts_of(frame, pages[2], pages[3]) == [wanted[2], wanted[3]]
    # one page has no template, and without one the furniture stays
    assert texts_of(frame, pages[0], pages[0])[0].startswith("The Site\ngo 0 0")
    monkeypatch.setattr(template, "templates", lambda pages, scratch: scratch.spark.createDataFrame(
        [], "host string, tags array<bigint>, strings array<bigint>, menus array<bigint>"))
    assert texts_of(frame, *pages) != wanted


def test_articles_are_kept_whole(frame):
    page = ("<body><header>Top</header><article><h1>T {0}</h1><p>Same words.</p><p><a>a link {0}</a></p>"
            "<div class='social history'>On society {0}</div><div class='ad'>Buy {0}</div></article>"
            "<article class=c1>a comment {1}</article><div>End</div></body>")
    pages = [page.format(n, n) for n in range(4)]
    got = texts_of(frame, *pages, pages[0])
    wanted = [f"T {n}\nSame words.\na link {n}\nOn society {n}" for n in range(4)]
    assert [t.removesuffix(f"\na comment {n}") for n, t in enumerate(got[:4])] == wanted and got[4] == got[0]
    extra = page.replace("<article class=c1>a comment {1}</article>", "{1}")
    some = [extra.format(n, f"<article class=c1>comment {n}</article>" * n) for n in range(5)]
    assert texts_of(frame, *some) == [f"T {n}\nSame words.\na link {n}\nOn society {n}" for n in range(5)]


def plain_classes(pages):
    """Valid classes of tags by whole vectors, from the definition."""
    pages = list(dict.fromkeys(pages))
    tokens = [template.page_tokens(p) for p in pages]
    vectors = {}
    for key in {k for t in tokens for k in t}:
        vector = tuple(t[key][0] if key in t else 0 for t in tokens)
        on = sum(n > 0 for n in vector)
        if on >= 2 and on >= len(pages) * template.SUPPORT:
            vectors.setdefault(vector, set()).add(key)
    once = {v: {k for k in ks if k[0] != "text"} for v, ks in vectors.items() if max(v) == 1}
    once = {v: ks for v, ks in once.items() if ks}
    mean = lambda k: (sum(t[k][1] for t in tokens if k in t), template.digest(*k))
    bad = set()
    for t in tokens:
        places = {v: [t[k][1] for k in sorted(ks, key=mean)] for v, ks in once.items() if next(iter(ks)) in t}
        bad |= {v for v, ps in places.items() if ps != sorted(ps)}
    for t in tokens:
        here = [v for v, ks in once.items() if next(iter(ks)) in t]
        spans = {v: sorted(t[k][1] for k in once[v]) for v in here}
        inside = lambda a, b: any(spans[b][0] < p < spans[b][-1] for p in spans[a])
        for v in here:
            bad |= {v for w in here if sum(w) > sum(v) and w not in bad and inside(v, w) and inside(w, v)}
    return {template.digest(*k) for v, ks in once.items() if v not in bad for k in ks}


def test_classes_are_those_of_whole_vectors(spark, frame):
    rng = random.Random(11)
    part = {c: f"<div class={c}>text of {c}</div>" for c in "abcdefg"}
    for count in (1, 2, 3, 5, 9, 16):
        pages = []
        for n in range(count):
            names = [c for c in "abcdefg" if rng.random() < {"a": 1, "b": 1, "c": 0.8, "d": 0.6}.get(c, 0.5)]
            if rng.random() < 0.3:
                rng.shuffle(names)
            body = "".join(part[c] if c != "f" else f"<section class=f>{n}</section>" * rng.randrange(1, 3) for c in names)
            pages.append(f"<html><body>{body}<p>own {n}</p></body></html>")
        pages += pages[:2]
        rows = [(i, f"https://x.org/{i}", p) for i, p in enumerate(pages)]
        with Scratch(spark) as scratch:
            found = template.templates(frame(rows, PAGE_SCHEMA).repartition(2), scratch).collect()
        assert (set(found[0].tags) if found else set()) == plain_classes(pages)


@pytest.mark.parametrize("text", ["<", "<a", "<!--", "<script>x", "a < b > c", "<p title='a>b'>x</p>"])
def test_broken_markup(text):
    assert isinstance(template.main_text(text), str)
