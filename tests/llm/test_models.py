"""The classifier, the language model, page text and the pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import DATA
from llm_helpers import edges, nothing  # noqa: F401
from oracle import connect, difference
from tabloom.llm import queries
from tabloom.llm.html_text import extract_text, page_text
from tabloom.llm.language_model import learn_weights, model_scores, squeezed, unsqueezed
from tabloom.llm.quality import DIMENSIONS, features, learn, quality_scores, summed


def test_features_match_whatever_comes_along():
    one = b"Some words, and some more words ### 12"
    alone = summed(*features([one]), 1)[0]
    among = summed(*features([b"", one, b"other"]), 3)
    assert len(among[0][0]) == 0
    assert (among[1][0] == alone[0]).all() and np.allclose(among[1][1], alone[1])


def test_learning():
    good, bad = [b"calm plain words in a row %d" % k for k in range(40)], [
        b"junk### junk### $$$ %d" % k for k in range(40)]
    found = summed(*features(good + bad), 80)
    w = learn([(i, x, float(k < 40)) for k, (i, x) in enumerate(found)])
    score = [w[i] @ x + w[-1] for i, x in found]
    assert w.shape == (DIMENSIONS,) and min(score[:40]) > 0 > max(score[40:])


def test_quality(spark, table, edges, nothing):
    docs, labels = table("documents"), table("labels")
    rows = quality_scores(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.9
    assert quality_scores(nothing, labels).count() == 0
    bare = quality_scores(edges, labels.where("false")).collect()
    assert len(bare) == edges.count() and all(r["score"] == 0.5 for r in bare)


def test_packed_numbers():
    a, b = np.array([0, 1, 2**63], np.uint64), np.array([5, 0, 7], np.uint64)
    assert [x.tolist() for x in unsqueezed(squeezed(a, b), 3, 2)] == [a.tolist(), b.tolist()]


def test_weights():
    p = np.array([[0.5, 0.01, 0.001], [0.0, 0.01, 0.001], [0.0, 0.0, 0.001]])
    w = learn_weights(np.array([3, 3, 3]), np.array([80.0, 15.0, 5.0]), p)
    assert np.allclose(w.sum(axis=1), 1) and (w > 0).all() and w[3, 0] > 0.5


def slow_model(rows):
    tokens = [(t or "").encode().lower().split() + [b" "] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(counts.values()), len(counts)
    return [(i, h, len(t), sum(w in counts for w in t), n,
             sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t))
            for (i, _), t, h in zip(rows, tokens, held, strict=True)]


def slow_scores(rows):
    """Deleted interpolation written plainly: token by token, probabilities as they are."""
    tokens = [(t or "").encode().lower().split() + [b" "] for _, t in rows]
    folds = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 for i, _ in rows]
    pairs = [list(zip([b" ", *t[:-1]], t, strict=True)) for t in tokens]
    def counted(wanted):
        own = [p for p, f in zip(pairs, folds, strict=True) if wanted(f)]
        return Counter(x for p in own for x in p), Counter(w for p in own for _, w in p)
    two, one = counted(lambda f: f != 2)
    two_off, one_off = counted(lambda f: f == 3)
    n, off = sum(one.values()), sum(one_off.values())
    rare = 1 / (len(one) + 1)
    told = {}
    for (v, w), times in two_off.items():
        c = one[v] - one_off[v]
        told.setdefault(c.bit_length(), []).append((times, (
            (two[v, w] - two_off[v, w]) / c if c else 0.0,
            (one[w] - one_off[w]) / max(1, n - off), rare)))
    def fit(data, start, lean):
        weights = start
        for _ in range(40):
            sums = [5 * x for x in lean]
            for times, p in data:
                mixed = [a * b for a, b in zip(weights, p, strict=True)]
                sums = [s + times * m / sum(mixed) for s, m in zip(sums, mixed, strict=True)]
            weights = [s / sum(sums) for s in sums]
        return weights
    even = [1 / 3] * 3
    every = fit([x for own in told.values() for x in own], even, even)
    weights = {k: fit(own, every, every) for k, own in told.items()}
    def chance(v, w):
        own = weights.get(one[v].bit_length(), every)
        return (own[0] * (two[v, w] / one[v] if one[v] else 0.0)
                + own[1] * one[w] / max(1, n) + own[2] * rare)
    return [sum(math.log10(chance(*x)) for x in p) for p in pairs]


def test_scores_by_brute_force(table, edges):
    # The operator learns from probabilities gathered in half octaves, hence the tolerance.
    for df, block in ((edges, 50), (table("documents"), 20_000)):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        found = model_scores(df, block=block, per_range=5_000).collect()
        want = zip(rows, slow_model(rows), slow_scores(rows), strict=True)
        key = lambda r: (str(r[0]), r[2], r[5])
        plain = sorted(((*m[:6], score) for _, m, score in want), key=key)
        for got, w in zip(sorted(map(tuple, found), key=key), plain, strict=True):
            assert got[6] == pytest.approx(w[6], rel=0.01)


def test_language_model(table, edges, nothing):
    assert model_scores(nothing).count() == 0
    for df, block in ((edges, 50), (table("documents"), 20_000)):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        found = model_scores(df, block=block, per_range=5_000).collect()
        want = slow_model(rows)
        key = lambda r: (str(r[0]), r[2], r[5])
        for got, w in zip(sorted(found, key=key), sorted(want, key=key), strict=True):
            assert tuple(got)[:5] == w[:5] and got["base_score"] == pytest.approx(w[5])
            assert got["score"] < 0
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_one_block_or_many(table):
    a, b = ({r["doc_id"]: r["score"] for r in model_scores(table("documents"), block=n).collect()}
            for n in (5_000, 10**9))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-6) for k in a)


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain &lt;text&gt;", "plain <text>"),
    ("<p>One <b>two\n three<p>next", "One two three\n\nnext"),
    ("a<br>b<div>c</div>d", "a\nb\nc\nd"),
    ("<ul><li>a<li>b<ol start=3><li>c</ol></ul>", "- a\n- b\n  3. c"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3</table>", "Name       Qty\napple pie  3"),
    ("<p hidden>no<p style='display: none'>no<p>yes", "yes"),
    ("<style>.x{display:none}</style><i class='y x'>no</i>yes", "yes"),
    ("<div style=visibility:hidden>no<b style=visibility:visible>yes</b></div>", "yes"),
    ("<script>if (a<b) '</p>'</script>yes<!-- no --><noscript>no</noscript>", "yes"),
    ("<title>T</title><pre>a\n  b</pre>", "a\n  b"),
    ("x <unfinished", "x"), ("a<a<a", "a"), ("<details><summary>s</summary>no</details>", "s"),
    ("<div>" * 3_000 + "deep", "deep"), ("1 < 2", "1 < 2"),
    ("<style>@media print{.note{display:none}} .x{color:red}</style><p class=note>yes", "yes"),
    ("<style>@media (max-width:9em){p{display:none}}@media screen, print{b{display:none}}</style>"
     "<p>yes <b>no</b>", "yes"),
    ("<style>.note{display:none}.note{display:block}</style><p class=note>yes", "yes"),
    ("<style>#a{display:block}.n{display:none}p{display:block}/*.y{display:none}*/</style>"
     "<p id=a class=n>one<p class='n y'>no<p class=y>two", "one\n\ntwo"),
    ("<style>@supports (x:y){@media all{.n{visibility:hidden}}} @font-face{src:x} i{display:none}"
     "</style><p class=n>no<p>yes<i>no</i><b class=n style='visibility:visible'>b</b>", "yesb"),
    ("<table><tr><td>" + "w" * 80 + "<td>a<td>b<tr><td>x<td>y<td>z</table>",
     "w" * 80 + "  a  b\nx" + " " * 81 + "y  z"),
    ("<table><tr><td rowspan=2>both<td>a<td rowspan=3>c<tr><td>b<tr><td>d<td>e</table>",
     "both  a  c\n      b\nd     e"),
    ("<table><tr><td colspan=2 rowspan=2>wide<td>a<tr><td>b<tr><td>1<td>2<td>3</table>",
     "wide  a\n      b\n1  2  3"),
    ("<div>" * 250 + "<div hidden><p>no<div>no</div>no</div>yes", "yes"),
    ("<div>" * 250 + "<script>no</script><p style=display:none>no</p>yes<b>b</b>", "yesb"),
])
def test_page_text(page, text):
    assert page_text(page)[1] == text


def test_tables_are_bounded():
    """A table that would take too much room when padded has narrow columns instead."""
    page = "<table>" + "<tr><td>a<td>b" * 9_000 + "<tr><td>" + "w" * 9_000 + "<td>c</table>"
    text = page_text(page)[1]
    assert text.startswith("a" + " " * 61 + "b\n") and text.endswith("w  c") and len(text) < 10**6


def test_extract_text(spark, nothing):
    pages = spark.createDataFrame(
        [(1, "<p>a", "t"), (1, "<p>a", "t"), (2, None, "t"), (None, "", None)],
        "page_id long, html string, title string")
    assert [tuple(r) for r in extract_text(pages).collect()] == [
        (1, "", "a"), (1, "", "a"), (2, "", ""), (None, "", "")]
    assert extract_text(pages.where("false")).count() == 0


def test_pipeline(spark, edges, nothing):
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert rows and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "exact_dedup", "near_dedup", "packing"]
    for docs in (edges, nothing):
        for _, step in corpus_pipeline.STAGES[:-1]:
            kept = step(spark, docs, DATA)
            assert kept.columns == docs.columns
            assert kept.count() <= docs.count()
    copies = corpus_pipeline.drop_copies(spark, edges, DATA)
    assert copies.count() == edges.selectExpr(
        "translate(coalesce(text, ''), 'THECA', 'theca') AS t").distinct().count()


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, DATA), connect(DATA), queries.ORACLE[name]) is None


def test_registered():
    names = set(entry.queries())
    assert {n for n in names if n.startswith("op")} == set(queries.QUERIES)
    assert "pipeline" in names and len(queries.QUERIES) == 13
