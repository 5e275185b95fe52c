import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlark.plans import leastsquares


def rows_of(seed, n):
    rng = random.Random(seed)
    return [(k, rng.choice("pqrst"), rng.choice([None, "u", "v", ""]), rng.randrange(5), rng.random() * 9) for k in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a string, b string, x int, y double")


def brute(rows, asked):
    """Predictions by a pseudo-inverse of the whole matrix."""
    names = [sorted({r[k] for r in rows}, key=str) for k in (1, 2)]

    def line(r):
        return [float(r[k + 1] == v) for k in (0, 1) for v in names[k]] + [float(r[3])]

    x, y = np.array([line(r) for r in rows]), np.array([r[4] for r in rows])
    b = np.linalg.pinv(x - x.mean(0)) @ (y - y.mean())
    return [float(y.mean() + (np.array(line(r)) - x.mean(0)) @ b) for r in asked], b


@pytest.mark.parametrize("dense", [2000, 0])
def test_equals_a_pseudo_inverse_for_any_layout(spark, dense):
    rows = rows_of(1, 200)
    asked = [*rows[:20], (900, "new", None, 2, 0.0), (901, "q", "new", 4, 0.0)]
    want, b = brute(rows, asked)
    for layout in (frame(spark, rows).coalesce(1), frame(spark, rows).repartition(6))[: 2 if dense else 1]:
        model = leastsquares.fit(layout, [F.col("y"), F.log1p("y")], ["a", "b"], ["x"], dense=dense)
        got = {r.id: r.p for r in model.with_predictions(frame(spark, asked), ["p", "q"]).collect()}
        assert [got[r[0]] for r in asked] == pytest.approx(want, abs=1e-7)
        assert np.linalg.norm(model.coefficients[:, 0]) == pytest.approx(np.linalg.norm(b), abs=1e-7)
    logs, _ = brute([(*r[:4], np.log1p(r[4])) for r in rows], asked)
    assert [r.q for r in model.with_predictions(frame(spark, asked), ["p", "q"]).orderBy("id").collect()] == pytest.approx([v for _, v in sorted(zip([r[0] for r in asked], logs, strict=True))], abs=1e-7)


def test_one_category_and_no_rows(spark):
    same = frame(spark, [(k, "p", "u", 1, float(k)) for k in range(5)])
    model = leastsquares.fit(same, [F.col("y")], ["a", "b"], ["x"])
    assert {r.p for r in model.with_predictions(same, ["p"]).collect()} == {2.0}
    none = leastsquares.fit(same.where("false"), [F.col("y")], ["a"], [])
    assert {r.p for r in none.with_predictions(same, ["p"]).collect()} == {0.0}


def test_too_many_categories_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(leastsquares, "WIDEST", 3)
    with pytest.raises(ValueError, match="more than 3"):
        leastsquares.fit(frame(spark, rows_of(2, 50)), [F.col("y")], ["a"], [])
