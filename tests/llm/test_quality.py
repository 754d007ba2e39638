"""Quality rules against a plain reading of the contract."""

import random
import re
from collections import Counter

from terrella.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n = Counter(windows)
    covered = {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def values(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_counts(spark):
    r = random.Random(3)
    texts = [None, "", "  \n ", "a", "a b c d e f g h " * 5, "x" * 50000, "é ü\n" * 3, "\x1cA\x0bB\x85C", "w " * 20000]
    texts += ["f", "f f f", "if x f", "foo bar of", "\x0cabc d", "f\x0c", "\x0b\x0cf\x0c\x0b", "fff\n\x0cfff\nf"]
    texts += ["".join(r.choice(["a", "b", " ", "\n", "#", "|", "é", "\t"]) for _ in range(r.randrange(200))) for _ in range(150)]
    rows = [(i, t, None if i % 5 == 0 else f"s{i % 3}", i) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, kept long")
    got = {x.doc_id: x.q for x in quality.assess(d, out="q").collect()}
    for i, t, *_ in rows:
        assert values(got[i]) == plain(t), t
        assert got[i].base_failed == (got[i].n_words < 20 or 100 * got[i].n_repeat_words > 30 * got[i].n_words)
    assert quality.assess(d.limit(0)).collect() == []


def test_boilerplate_goes_and_depleted_documents_are_rejected(spark):
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(40))
    line = "Accept all  cookies " + " ".join(f"c{k}" for k in range(30))
    rows = [(i, f"{body(i)}\n{line.upper() if i % 2 else line}", "h") for i in range(30)] + [(99, line, "h"), (98, line, "other"), (97, f"{line}\nbut {body(5)}", None)]
    # Copies of one text count once, however many there are.
    rows += [(200 + i, body(7000), "copies") for i in range(30)]
    got = {r.doc_id: r.quality for r in quality.assess(spark.createDataFrame(rows, "doc_id long, text string, source string"), keep_text=True).collect()}
    assert all(got[i].kept and got[i].words_left == 40 and got[i].text == body(i) for i in range(30))
    assert not got[99].kept and not got[99].base_failed and got[99].words_left == 0
    assert got[98].kept and got[97].kept and all(got[200 + i].kept for i in range(30))


def test_lines_of_a_large_host_go(spark):
    """A line in one of twelve texts of a host of 1,200, next to prose that no text shares."""
    line = "Terms of use apply to all of this"
    rows = [(i, "\n".join([*(" ".join(f"w{i}x{j}y{k}" for k in range(12)) for j in range(3)), *([line] if i % 12 == 0 else [])]), "hot") for i in range(1200)]
    rows += [(5000, "\n".join([line] * 4), "hot"), (5001, "\n".join([line] * 4), "small")]
    got = {r.doc_id: r.quality for r in quality.assess(spark.createDataFrame(rows, "doc_id long, text string, source string"), keep_text=True).collect()}
    assert all(got[i].kept and got[i].words_left == 36 and line not in got[i].text for i in range(1200))
    assert not got[5000].kept and got[5000].words_left == 0
    assert got[5001].words_left == got[5001].n_words
