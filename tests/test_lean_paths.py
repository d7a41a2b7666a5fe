"""Steps that read only the layers they need."""

import datetime

import pytest

from keepwell.operators import features as feat, segments
from keepwell.plans import fitted, model_queries  # noqa: F401  (importing registers)
from keepwell.plans import reference_rules as rules
from keepwell.plans.lake import Lake
from keepwell.plans.registry import QUERIES
from keepwell.session import stored

SMALL = "/root/testdata/sf0.001"


class Watched(Lake):
    """A lake that tells which clean tables were asked for."""

    def __init__(self, spark, sf_dir):
        super().__init__(spark, sf_dir)
        self.asked = set()

    def table(self, name):
        self.asked.add(name)
        return super().table(name)


def _orders(spark):
    day = datetime.date(2024, 5, 1)
    rows = [(f"O{i}", f"C{i % 7}", float(i), 0.5, day - datetime.timedelta(days=11 * i)) for i in range(40)]
    rows += [("O90", "C90", 5.0, None, day), ("O91", "C91", 5.0, 1.0, None), ("O92", None, 5.0, 1.0, day)]
    return spark.createDataFrame(rows, "order_id string, customer_id string, order_amount double, discount_amount double, order_date date")


def test_recency_orders_and_spend_need_the_orders_alone(spark):
    def empty(columns):
        return spark.createDataFrame([], columns)
    orders = _orders(spark)
    sides = (empty("order_id string, payment_method string"), empty("customer_id string, refund_id string"),
             empty("customer_id string, event_id string, action string"),
             empty("customer_id string, session_id string, channel string, pages_viewed int, session_duration_seconds int"),
             empty("customer_id string, rating int"))
    whole = feat.feature_table(orders, *sides).select("customer_id", *segments.RFM)
    base = feat.customer_base(stored(feat.rfm_base(orders), "rfm_base"))
    lean = feat.rfm_filled(base)
    assert lean.schema.simpleString() == whole.schema.simpleString()
    assert sorted(lean.collect()) == sorted(whole.collect()) and lean.where("recency_days is null").isEmpty() and lean.count() == 9
    again = feat.feature_table(orders, *sides, base=base).select("customer_id", *segments.RFM)
    assert sorted(again.collect()) == sorted(whole.collect())


def test_bands_are_those_of_the_predictions(spark, lake):
    whole = lake.rule_predictions().select("customer_id", "churn_probability", "churn_risk_band")
    assert sorted(map(tuple, rules.banded(lake.rfm_filled()).collect())) == sorted(map(tuple, whole.collect()))


@pytest.mark.parametrize("name, needed", [("rerank_segment_baskets", {"orders", "cart_events"}), ("insight_by_risk_band", {"orders", "reviews"})])
def test_queries_ask_only_for_what_their_rows_follow_from(spark, monkeypatch, name, needed):
    lakes = []

    def watched(session, sf_dir):
        lakes.append(Watched(session, sf_dir))
        return lakes[-1]
    monkeypatch.setattr("keepwell.plans.registry.Lake", watched)
    assert QUERIES[name](spark, f"{SMALL}{'/' * len(name)}").count() > 0  # a name of its own: nothing has been written under it
    assert lakes[0].asked == needed


def test_segment_points_ask_only_for_orders(spark):
    lake = Watched(spark, f"{SMALL}//")
    assert fitted.clipped(lake).count() > 0 and lake.asked == {"orders"}
