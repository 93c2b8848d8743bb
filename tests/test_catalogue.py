"""The view catalogue: order, errors, publishing."""

import pytest

from salesmart.operators.catalogue import Catalogue
from salesmart.plans import q_views


def small():
    c = Catalogue()
    c.add("top_v", ["mid_v", "side_v"], "SELECT m.k, m.n + s.n AS n FROM mid_v m JOIN side_v s USING (k)")
    c.add("mid_v", ["base_v"], "SELECT k, n * 10 AS n FROM base_v")
    c.add("side_v", ["base_v"], build=lambda b: b.where("k > 1"))
    c.add("base_v", base=True)
    c.add("other_base", base=True)
    return c


def test_views_are_published_after_what_they_read(spark):
    made = []
    rows = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "k int, n int")
    bases = {"base_v": lambda: made.append("base_v") or rows, "other_base": lambda: made.append("other_base") or rows}
    done = small().publish(spark, bases, ["top_v"])
    assert done[0] == "base_v" and done[-1] == "top_v" and set(done) == {"base_v", "mid_v", "side_v", "top_v"} and made == ["base_v"]
    assert {tuple(r) for r in spark.sql("SELECT k, n FROM top_v").collect()} == {(2, 22), (3, 33)}
    small().publish(spark, {"base_v": lambda: rows.where("k = 3")}, ["top_v"])      # published anew over other data
    assert [tuple(r) for r in spark.sql("SELECT * FROM top_v").collect()] == [(3, 33)]


def test_wrong_catalogues_are_refused(spark):
    c = small()
    for bad in (lambda: c.add("top_v", sql="SELECT 1"), lambda: c.add("x"), lambda: c.add("x", sql="SELECT 1", base=True),
                lambda: c.order(["nowhere"]), lambda: c.publish(spark, {}, ["base_v"])):
        with pytest.raises(ValueError):
            bad()
    c.add("a", ["b"], "SELECT * FROM b")
    c.add("b", ["a"], "SELECT * FROM a")
    with pytest.raises(ValueError, match="read each other"):
        c.order(["a"])


def test_every_published_view_is_in_the_catalogue():
    assert len(q_views.MART_OF) == 15 and set(q_views.MART_OF) <= set(q_views.CATALOGUE.views)
    order = q_views.CATALOGUE.order()
    assert all(order.index(n) < order.index(v.name) for v in q_views.CATALOGUE.views.values() for n in v.needs)
