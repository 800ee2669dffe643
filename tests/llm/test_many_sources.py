"""Raking of more sources than the driver should hold."""

import numpy as np
import pytest

from larch.llm import mixing


def _docs(spark, sources):
    """Sources of very different sizes, in three languages."""
    rows = []
    for k in range(sources):
        n = max(1, sources // (k + 1))
        for i in range(min(n, 4)):
            rows.append((len(rows), " ".join(f"w{(k * 31 + i * 7 + j) % 97}" for j in range(max(4, n // 4))), f"s{k}", "abc"[(k + i) % 3]))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(3)


def test_each_of_many_sources_is_raked_by_itself(spark):
    rows = mixing.mix_documents(_docs(spark, 1500)).toPandas()
    have = rows["tokens"].groupby(rows["source"]).sum()
    assert set(have.index) == {f"s{k}" for k in range(1500)}
    shares = {"s1400": 0.001}
    given = mixing.mix_documents(_docs(spark, 1500), shares={"source": shares | {f"s{k}": 1.0 for k in range(5)}}).toPandas()
    assert given["probability"].between(mixing.MIN_PROBABILITY, 1).all()
    p = given.groupby("source")["probability"].mean()
    assert p["s1400"] > mixing.MIN_PROBABILITY and p["s1401"] == mixing.MIN_PROBABILITY


@pytest.mark.parametrize("shares", [None, {"source": {"s0": 0.5, "s3": 0.4}}])
def test_tables_give_the_probabilities_of_the_driver(spark, shares):
    cells = mixing.Mix(_docs(spark, 40), 0.6, 0.7, None).rows.groupBy(*mixing.DIMENSIONS).agg({"tokens": "sum"}).toDF(*mixing.DIMENSIONS, "tokens")
    cells = mixing.materialize(cells, "test_cells")
    frame = cells.toPandas()
    tokens, codes, targets = frame["tokens"].to_numpy(dtype=float), [], []
    for d in mixing.DIMENSIONS:
        code, names = mixing.pd.factorize(frame[d], sort=True)
        given = (shares or {}).get(d)
        targets.append(np.array([given.get(x, 0.0) for x in names]) * 0.6 * tokens.sum() if given
                       else mixing.target_tokens(np.bincount(code, tokens, len(names)), 0.6, 0.7))
        codes.append(code)
    want = frame.assign(want=mixing.rake(tokens, codes, targets, rounds=4))
    got = mixing.table_probabilities(cells, 0.6, 0.7, shares, rounds=4).toPandas()
    both = want.merge(got, on=list(mixing.DIMENSIONS))
    assert len(both) == len(frame) and np.allclose(both["want"], both["p"], rtol=1e-9)


def test_documents_come_back_when_cells_stay_tables(spark, monkeypatch):
    docs = _docs(spark, 12)
    monkeypatch.setattr(mixing, "ROUNDS", 3)
    want = sorted(mixing.mix_documents(docs).select("doc_id", "source", "topic").collect())
    monkeypatch.setattr(mixing, "DRIVER_CELLS", 0)
    monkeypatch.setattr(mixing, "TOLERANCE", 0.5)
    assert sorted(mixing.mix_documents(docs).select("doc_id", "source", "topic").collect()) == want
