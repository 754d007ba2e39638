"""Personal data against plain expressions, disclosing terms by hand, languages on rows not fitted on."""

import hashlib
import random
import re

from terrella.llm import language_id as L
from terrella.llm import pii

KINDS = pii.KINDS


def plain(t):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 16 <= len(d) <= 19 and sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans():
    r = random.Random(1)
    bits = ["a", "B9", "@", ".", "-", "+", "1", "25", "255", "300", " ", "é", "(", ")", "4111111111111111", "x@y.z", "+1 555 123 4567", "10.0.0.1", "_", "%"]
    for _ in range(20000):
        t = "".join(r.choice(bits) for _ in range(r.randrange(16)))
        assert pii.base_spans(t) == plain(t), t
    assert pii.base_spans("a" * 200_000 + "@" + "1" * 200_000) == []


def test_terms_that_disclose(spark):
    r = random.Random(2)
    common = lambda: " ".join(r.choice(["common", "words", "here", "there", "other"]) for _ in range(30))
    near = [(i, f"alpha contact jane@x.org about zebrafish {common()} q{i}") for i in range(6)]
    far = [(10 + i, f"common words here there other alpha contact about {i} zzz") for i in range(40)]
    d = spark.createDataFrame([*near, *far, (99, None), (100, ""), (0, near[0][1])], "doc_id long, text string")
    got = {x.doc_id: x for x in pii.report(d).collect()}
    assert got[0].spans == "email:14:24,term:31:40" and got[0].n_email == 1
    assert got[0].base_sha256 == hashlib.sha256(b"email:14:24").hexdigest()
    assert got[99].spans == got[100].spans == got[12].spans == ""
    clean = {x.doc_id: x.sanitised for x in pii.sanitised(d).collect()}
    assert clean[1].startswith("alpha contact [EMAIL] about [TERM] ") and clean[99] == ""
    # Copies of one text are one observation.
    same = spark.createDataFrame([(i, near[0][1]) for i in range(9)] + far, "doc_id long, text string")
    assert all("term" not in x.spans for x in pii.report(same).collect())
    assert pii.report(d.limit(0)).collect() == []


def test_terms_that_disclose_rare_entities(spark):
    common = "common words here there other " * 6
    # Each entity is in one text; only their domain, or in the end their kind, is in several.
    near = [(i, f"alpha {common}write to user{i}@x.org of zebrafish {common} q{i}") for i in range(4)]
    phones = [(20 + i, f"alpha {common}call +{i + 1}{i + 1} 55{i}7 123 456{i} at quokka {common}") for i in range(4)]
    far = [(100 + i, f"{common} alpha write to call of at {i}") for i in range(60)]
    got = {x.doc_id: x.spans for x in pii.report(spark.createDataFrame([*near, *phones, *far], "doc_id long, text string")).collect()}
    for rows, kind, term in ((near, "email", "zebrafish"), (phones, "phone", "quokka")):
        for i, t in rows:
            at = t.index(term)
            assert got[i].startswith(kind) and got[i].endswith(f",term:{at}:{at + len(term)}") and got[i].count("term") == 1
    assert all(got[i] == "" for i, _ in far)


def test_terms_of_any_script_are_found_in_the_whole_text(spark):
    common = "common words here there other " * 6
    for term in ("Li", "Иванов", "王小明", "हिन्दी", "k9_x", "z" * 70):
        near = [(i, f"{term} {common} write to jane@x.org {term}, {i} {common} by {term.upper()}.") for i in range(4)]
        # Holds the entity, and the term far from it; the same term without the entity stays.
        near.append((9, f"{term}: {common} {common} ask jane@x.org {common} write to by"))
        far = [(100 + i, f"{common} write to ask by {i}") for i in range(60)]
        got = {x.doc_id: x.spans for x in pii.report(spark.createDataFrame([*near, *far], "doc_id long, text string")).collect()}
        for i, t in near:
            want = [f"term:{m.start()}:{m.end()}" for m in re.finditer(re.escape(term), t, re.I)]
            assert got[i].split(",")[1:] == want and len(want) == (1 if i == 9 else 3), (term, got[i])
        assert all(got[i] == "" for i, _ in far)


def test_languages(spark, sf):
    docs = spark.read.parquet(sf.replace("0.001", "0.01") + "/documents.parquet")
    train, held = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    got = L.identify(held, L.fit(train, "text", "lang"), host="source").join(held.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.text_language == r.lang for r in got) >= 0.98 * len(got)
    assert sum(r.language == r.lang for r in got) >= 0.98 * len(got)


def test_evidence_adds_up(spark):
    rows = [(i, "the and that with this have", "en", "en", "a.uk") for i in range(30)] + [(100 + i, "der und das mit nicht eine", "de", "de", "b.de") for i in range(30)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, declared string, host string")
    m = L.fit(d, "text", "lang", "declared", "host")
    odd = spark.createDataFrame([(1, None, "de", None), (2, "", None, "b.de"), (3, "the and that", None, None), (4, "xq", "en", "b.de"), (5, None, None, None), (5, None, None, None)], "doc_id long, text string, declared string, host string")
    got = {r.doc_id: r for r in L.identify(odd, m, declared="declared", host="host").collect()}
    assert (got[1].language, got[2].language, got[3].language) == ("de", "de", "en")
    assert got[1].text_language is None and abs(got[5].confidence - 0.5) < 1e-6
    assert L.identify(odd.limit(0), m).collect() == []
    empty = L.fit(d.limit(0), "text", "lang")
    assert L.identify(odd, empty).filter("language is null and kept").count() == 6


def test_address_parts(spark):
    d = spark.createDataFrame([("https://u@www.a.fr:80/x?y", "www.a.fr", "fr"), ("http://B.De", "b.de", "de"), ("nothing", "", "")], "url string, host string, suffix string")
    got = d.select(L.host_of(d.url).alias("h"), L.suffix_of(L.host_of(d.url)).alias("s"), "host", "suffix").collect()
    assert all((r.h, r.s) == (r.host, r.suffix) for r in got)


def test_pages(spark, sf, monkeypatch):
    from terrella.llm import queries

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    seen = {}
    identify = L.identify
    monkeypatch.setattr(L, "identify", lambda df, model, *a, **k: seen.update(model=model, **k) or identify(df, model, *a, **k))
    got = queries.QUERIES["op7_language_id_pages"](spark, sf).collect()
    said = {r.page_id: r.declared for r in L.markup(pages).collect()}
    assert sorted(r.page_id for r in got) == sorted(said) and seen["declared"] and seen["host"]
    assert set(seen["model"].suffix) == {"com", "net", "org"} and seen["model"].declared
    assert sum(r.language == said[r.page_id] for r in got) >= 0.95 * len(got)
    # The label that the model is fitted on is no evidence.
    seen.clear()
    queries.op7_language_id(spark, sf)
    assert not seen.get("declared") and not seen["model"].declared


def test_markup(spark):
    rows = [('<!DOCTYPE html><HTML class="x" lang=\'pt-BR\'><script>var t="</p> the";</script><!-- a > b --><p title="q">ol&aacute; voc\u00ea</p>', "https://www.A.br/x"), ("<p>x</p>", "none"), (None, None)]
    got = L.markup(spark.createDataFrame(rows, "html string, url string")).collect()
    assert (got[0].text.split(), got[0].declared, got[0].host) == (["ol", "voc\u00ea"], "pt", "www.a.br")
    assert [(r.declared, r.host) for r in got[1:]] == [(None, None)] * 2 and got[2].text is None


def test_all_languages_of_the_sample_count(spark):
    r = random.Random(5)
    words = {f"l{k:02}": ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(8)] for k in range(70)}
    rows = [(f"{k} {i}", " ".join(r.choice(w) for _ in range(12)), k, f"d{k}", f"h.{k[0]}{chr(97 + int(k[1]))}{chr(97 + int(k[2]))}") for k, w in words.items() for i in range(5)]
    d = spark.createDataFrame(rows, "doc_id string, text string, lang string, declared string, host string")
    m = L.fit(d, "text", "lang", "declared", "host")
    assert m.languages == sorted(words) and len(m.declared) == len(m.suffix) == 70
    got = L.identify(d, m).collect()
    assert len(got) == 350 and all(x.language == x.doc_id.split()[0] for x in got)
