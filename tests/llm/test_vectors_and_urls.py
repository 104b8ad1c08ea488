"""Whitening, hard negatives and URL verdicts against brute force."""

import random
import re

import duckdb
import numpy as np
import pytest
from logquarry.llm import hard_negatives as hn, queries, whitening
from logquarry.llm.hard_negatives import hard_negatives
from logquarry.llm.url_filter import labelled_urls, ranked, train, url_verdicts
from logquarry.llm.whitening import whiten
from pyspark.sql import functions as F

from .conftest import SF

NAN, INF = float("nan"), float("inf")
ODD = [(None, 1), ([None, 1.0, 0.0], 1), ([NAN, 1.0, 0.0], 1), ([INF, 0.0, 1.0], 0), ([-INF, 0.0, 1.0], None)]


def vectors(spark, rows, extra=""):
    """Rows of (vec_id, embedding, label), with further columns of clashing names."""
    more = [3] * extra.count(",")
    return spark.createDataFrame([(*r, *more) for r in rows], f"vec_id long, embedding array<float>, label int{extra}")


CLASHING = ", id int, x int, index int, row int, n int, score int, place int, anchor int, w int, away int"


# -- whitening -----------------------------------------------------------------------------------------------


def plain_whitened(rows, count=16):
    """vec_id -> (n, deviation, whitened) up to the sign of each component, shares."""
    kept = [(i, v) for i, v, *_ in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in kept], dtype=object)
    distinct = np.array(sorted(set(map(tuple, x))), dtype=object)
    n, s = len(distinct), distinct.sum(axis=0)
    centred = (n * distinct - s).astype(float) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:count]
    values, basis = values[order], basis[:, order]
    away = n * x - s
    return [i for i, _ in kept], n, (away**2).sum(axis=1), (away.astype(float) / n) @ basis / np.sqrt(values), values


def check_whitened(frame, rows, count=16):
    got = frame.toPandas()
    ids, n, deviation, white, values = plain_whitened(rows, count)
    assert len(got) == len(ids) * white.shape[1] and set(got.n) == {n} and got.identity_error.max() < 1e-9
    got = got.sort_values(["component", "vec_id", "whitened"])
    for k in range(white.shape[1]):
        mine = got[got.component == k + 1]
        assert mine.deviation.tolist() == [d for _, d in sorted(zip(ids, deviation.tolist()))]
        signed = min(
            np.abs(mine.whitened.to_numpy() - [w for _, w in sorted(zip(ids, (sign * white[:, k]).tolist()))]).max()
            for sign in (1, -1)
        )
        assert signed < 1e-7
    shares = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(shares * values[0], values[: len(shares)] * shares[0], rtol=1e-9)


def test_whitening_of_the_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    check_whitened(queries.QUERIES["op11_embedding_whitening"](spark, SF), [tuple(r) for r in rows])


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=3).tolist(), 0) for i in range(30)]
    rows += [(100 + i, rows[0][1], 0) for i in range(40)]  # copies count once in the fit
    rows += [rows[3]] * 2
    odd = [(200 + i, v, l) for i, (v, l) in enumerate(ODD)] + [(300, [1.0, 2.0], 0), (301, [], 0)]
    frame = vectors(spark, rows + odd, CLASHING).repartition(5)
    result = whiten(frame)
    assert result.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitened(result, rows)
    assert abs(sum({r.component: r.explained for r in result.collect()}.values()) - 1) < 1e-9
    unnamed = whiten(vectors(spark, [(None, *r[1:]) for r in rows])).collect()
    assert len(unnamed) == 3 * len(rows) and {r.vec_id for r in unnamed} == {None}


def test_whitening_without_variance(spark):
    assert whiten(vectors(spark, [])).collect() == []
    assert whiten(vectors(spark, [(1, [1.0, 2.0], 0)] * 5)).collect() == []
    flat = [(i, [float(i % 4), 7.0], 0) for i in range(9)]  # one dimension is constant: one component
    assert {r.component for r in whiten(vectors(spark, flat)).collect()} == {1}
    assert whiten(vectors(spark, flat)).dtypes == whiten(vectors(spark, [])).dtypes


def test_whitening_in_many_blocks(spark, monkeypatch):
    """Blocks of a few rows and columns, several to a task: the same result."""
    monkeypatch.setattr(whitening, "LEAST_BYTES", 8 * 5 * 7)
    monkeypatch.setattr(whitening, "MOST_BYTES", 8 * 5 * 7)
    monkeypatch.setattr(whitening, "WIDTH", 2)
    monkeypatch.setattr(whitening, "TOGETHER", 2)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=5).tolist(), 0) for i in range(60)]
    check_whitened(whiten(vectors(spark, rows).repartition(3)), rows)


# -- hard negatives ------------------------------------------------------------------------------------------


def plain_negatives(rows, scale=256, positives=5, negatives=5):
    valid = [
        (i, l, [int(np.floor(scale * float(np.float32(c)))) for c in v])
        for i, v, l in rows
        if i is not None and l is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)
    ]
    out = []
    for k, (i, label, x) in enumerate(valid):
        if i % 10:
            continue
        scores = [
            (-sum(p * q for p, q in zip(x, y)), j, other == label)
            for m, (j, other, y) in enumerate(valid)
            if m != k and len(x) == len(y)
        ]
        for p, pid, _ in sorted(s for s in scores if s[2])[:positives]:
            fitting = sorted(s for s in scores if not s[2] and -80 * p <= -100 * s[0] <= -100 * p)[:negatives]
            out += [(i, pid, rank, nid, -p, -s) for rank, (s, nid, _) in enumerate(fitting, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = vectors(spark, rows, CLASHING).repartition(3)
    return sorted(tuple(r) for r in hard_negatives(frame, F.col("vec_id") % 10 == 0, **options).collect())


def test_hard_negatives_of_the_table(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.sql(queries.ORACLES["op12_hard_negatives"])
    got = queries.QUERIES["op12_hard_negatives"](spark, SF).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall()) and got


@pytest.mark.parametrize("seed", range(2))
def test_hard_negatives_of_odd_rows(spark, seed, monkeypatch):
    """Ties, repeated rows, a label with most rows, vectors of two lengths; several blocks of each kind."""
    monkeypatch.setattr(hn, "ROWS", 16)
    monkeypatch.setattr(hn, "ANCHORS", 3)
    monkeypatch.setattr(hn, "HELD", 2)
    rng = random.Random(seed)
    rows = [(i, [rng.randrange(-2, 6) / 4 for _ in range(3)], 0 if rng.random() < 0.6 else rng.randrange(4)) for i in range(90)]
    rows += [rows[10], rows[10], rows[20], rows[33]]
    rows += [(100 + i, [rng.random(), rng.random()], i % 2) for i in range(12)] + [(120, [], 0), (121, [], 0), (130, [], 1)]
    odd = [(200 + 10 * i, v, l) for i, (v, l) in enumerate(ODD)] + [(None, [1.0, 1.0, 1.0], 1), (300, [1.0, 1.0, 1.0], None)]
    want = plain_negatives(rows + odd)
    assert mined(spark, rows + odd) == want and len(want) > 50
    assert mined(spark, rows, positives=1, negatives=2) == plain_negatives(rows, positives=1, negatives=2)


def test_hard_negatives_of_long_vectors(spark):
    """Whose bounds rule pairs out: few are left to score. Components too large for doubles are scored as integers."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 40)).cumsum(axis=1)
    rows = [(i, (centres[i % 6] + rng.normal(size=40) / 9).tolist(), i % 2) for i in range(150)]
    assert mined(spark, rows) == plain_negatives(rows)
    large = [(i, [float(rng.integers(1, 9)) * 2.0**19, 1.0, -(2.0**18)], i % 3) for i in range(25)]
    assert mined(spark, large) == plain_negatives(large)


def test_bounds_hold():
    rng = np.random.default_rng(3)
    for dims in (1, 3, 16, 23, 64):
        x = np.floor(rng.normal(size=(40, dims)).cumsum(axis=1) * 50)
        fine = hn.summaries(x)
        for segments in hn.LEVELS:
            m, d = hn.coarser(*fine, dims, segments)
            middle, width = m @ m.T, d @ d.T + 1e-6 * np.outer(*[np.linalg.norm(x, axis=1)] * 2) + 1e-6
            assert (np.abs(x @ x.T - middle) <= width).all()


def test_hard_negatives_of_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []  # no anchors
    assert mined(spark, [(10, [1.0], 0)]) == []


# -- URL verdicts --------------------------------------------------------------------------------------------

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def plain_verdict(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def test_url_verdicts_of_the_table(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.QUERIES["op13_url_filter"](spark, SF).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = plain_verdict(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


ODD_URLS = [
    None, "", "no scheme", "://", "http://", "http://?q", "http://#x", "HTTP://Shop.Example.ORG/ES/", "http://example.org/es/", "http://a.example.org/en/1?x",
    "http://notexample.org/es/1", "http://org", "http://org/", "http://x.org?/es/", "http://user@b.com:80/de/x://y/fr/", "http://COM/fr/\n/x", "a://b://c/d",
    "x\ny://Ä.com/de/ü#ü", "ftp://É.ORG/é", "http://" + "a" * 70_000 + ".com/fr/" + "b/" * 50_000, "http://a.com/de", "http://example.org/en/12",
]


def test_url_verdicts_of_odd_urls(spark):
    extra = ", rule int, host int, path int, grams int, features int, verdict int, url_ int, odds int, ruled int, guess int, margin int"
    rows = [(i, u, *[5] * extra.count(",")) for i, u in enumerate(ODD_URLS)] + [(3, "http://a.org/", *[5] * extra.count(","))] * 2 + [(None, "http://a.org/", *[5] * extra.count(","))]
    frame = spark.createDataFrame(rows, "page_id long, url string" + extra)
    got = sorted((tuple(r)[:5] for r in url_verdicts(frame).collect()), key=repr)
    assert len(got) == len(rows)
    for row, (_, url, *_rest) in zip(got, sorted(rows, key=lambda r: repr((r[0], *plain_verdict(r[1]))))):
        host, path, rule, verdict = plain_verdict(url)
        assert row[1:4] == (host, path, rule) and row[4] == (verdict or row[4])
    assert url_verdicts(frame.limit(0)).collect() == []


def test_longest_rule_wins_and_ties(spark):
    assert [r[1] for r in ranked(["allow b/cc/d", "block a.b/cc", "allow a.b/cc", "block b/"])] == ["a.b/cc", "a.b/cc", "b/cc/d", "b/"]
    assert ranked(["allow a.b/cc", "block a.b/cc"])[0][0] == "block"
    for wrong in ("allow org", "forbid org/", "block /x"):
        with pytest.raises(ValueError):
            ranked([wrong])
    frame = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert url_verdicts(frame, rules=[]).first().rule is None


def test_model_on_held_out_urls(spark):
    """Four folds of the labelled table: each judged by a model fitted on the rest."""
    labelled, right = labelled_urls(spark).collect(), 0
    for fold in range(4):
        rest = spark.createDataFrame([r for i, r in enumerate(labelled) if i % 4 != fold], "url string, blocked double")
        held = [(i, r.url) for i, r in enumerate(labelled) if i % 4 == fold]
        got = url_verdicts(spark.createDataFrame(held, "page_id long, url string"), rules=[], labelled=rest).collect()
        right += sum((r.verdict == "block") == (labelled[r.page_id].blocked == 1) for r in got)
    assert right / len(labelled) >= 0.85


def test_labelled_table_may_hold_nulls_and_is_bounded(spark):
    rows = labelled_urls(spark).unionByName(spark.createDataFrame([(None, 1.0), ("http://x/", None)], "url string, blocked double"))
    assert train(rows).coefficients == train(labelled_urls(spark)).coefficients
    assert train(rows, most=50).numFeatures == train(rows).numFeatures


def test_url_filter_stays_in_the_jvm(spark):
    plan = queries.QUERIES["op13_url_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
