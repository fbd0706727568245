from conftest import ORDER_COLUMNS, by_key, table

from arrivo.operators.label import build_target, compare_label_rules
from arrivo.schemas import TARGET

COLUMNS = (
    "order_id order_status order_delivered_customer_date order_estimated_delivery_date"
    " order_purchase_timestamp"
)


def cases(spark, purchase="2017-12-28 10:00:00"):
    rows = [
        ("a", "delivered", "2018-01-10 15:00:00", "2018-01-10", purchase),
        ("b", "delivered", "2018-01-11 09:00:00", "2018-01-10", purchase),
        ("c", "delivered", "2018-01-08 10:00:00", "2018-01-10", purchase),
        ("d", "canceled", "2018-01-20 10:00:00", "2018-01-10", purchase),
        ("e", "delivered", None, "2018-01-10", purchase),
        ("f", "delivered", "no es fecha", "2018-01-10", purchase),
    ]
    return table(spark, rows, COLUMNS)


def labels(df):
    return {k: r[TARGET] for k, r in by_key(df).items()}


def test_same_day_is_on_time(spark):
    assert labels(build_target(cases(spark))) == {"a": 0, "b": 1, "c": 0}


def test_timestamp_rule(spark):
    assert labels(build_target(cases(spark), by_calendar_day=False)) == {"a": 1, "b": 1, "c": 0}


def test_rules_share_the_population(spark):
    pairs = by_key(compare_label_rules(cases(spark)))
    assert {k: (r[1], r[2]) for k, r in pairs.items()} == {"a": (0, 1), "b": (1, 1), "c": (0, 0)}


def test_input_is_not_changed(spark):
    df = cases(spark)
    before = df.collect()
    build_target(df).collect()
    assert df.collect() == before and TARGET not in df.columns


def test_study_period_is_half_open(spark):
    moments = ["2016-12-31 23:59:00", "2017-01-01 00:00:00", "2018-08-31 23:59:00", "2018-09-01 00:00:00", "???"]
    rows = [(str(i), "delivered", "2018-10-01 10:00:00", "2018-10-05", m) for i, m in enumerate(moments)]
    df = table(spark, rows, COLUMNS)
    assert set(labels(build_target(df))) == {"1", "2"}
    assert set(labels(build_target(df, only_study_period=False))) == set("01234")


def test_typed_and_text_dates_agree(spark, tables):
    text = tables["orders"].select(*[tables["orders"][c].cast("string") for c in ORDER_COLUMNS.split()])
    assert labels(build_target(text)) == labels(build_target(tables["orders"])) == {"o1": 0, "o2": 1, "o3": 0}
