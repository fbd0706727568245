"""Checks, audits, star schema, readers and writers."""

from datetime import datetime

import pytest
from conftest import by_key, market, order_rows, table, values
from pyspark.sql import functions as F

from arrivo.operators import checks, profile
from arrivo.plans import star
from arrivo.plans.view import analytic_view, create_catalog_view
from arrivo.schemas import TABLES
from arrivo.sources import readers, releases, sinks

REVIEWS = [
    ("r1", "o1", 1, None, "tarde", "2017-01-21 00:00:00", "2017-01-22 10:00:00"),
    ("r2", "o1", 5, None, None, "2017-01-23 00:00:00", "2017-01-24 10:00:00"),
    ("r3", "o2", 3, "t", 'con "comillas"\ny salto', "2017-07-16 00:00:00", None),
    ("r0", "o2", 2, None, "antes", "2017-07-15 00:00:00", "2017-07-15 10:00:00"),
]
REVIEW_COLUMNS = (
    "review_id order_id review_score review_comment_title review_comment_message"
    " review_creation_date review_answer_timestamp"
)


def full_market(spark, **changes):
    """All nine tables with all their columns."""
    tables = market(spark, **changes)
    tables["reviews"] = table(spark, REVIEWS, REVIEW_COLUMNS, "reviews")
    tables["translation"] = table(
        spark, [("moveis", "furniture")], "product_category_name product_category_name_english", "translation"
    )
    tables["payments"] = tables["payments"].withColumn("payment_sequential", F.lit(1).cast("long"))
    for name, spec in TABLES.items():
        for column, kind in spec.columns:
            if column not in tables[name].columns:
                tables[name] = tables[name].withColumn(column, F.lit(None).cast(kind))
        tables[name] = tables[name].select(*[c for c, _ in spec.columns])
    tables["customers"] = tables["customers"].withColumn("customer_unique_id", F.col("customer_id"))
    return tables


@pytest.fixture
def nine(spark):
    return full_market(spark)


def test_sound_tables_pass(nine):
    for check in (checks.check_keys(nine), checks.check_references(nine), checks.check_required(nine)):
        assert all(r.ok for r in check.collect())


def test_broken_tables_fail(spark):
    broken = full_market(
        spark,
        items=[("o1", 1, "p1", "s1", None, 1, 1), ("o1", 1, "p9", "s1", None, 1, 1), ("o7", None, "p1", None, None, 1, 1)],
    )
    keys = {r.prueba: r.ok for r in checks.check_keys(broken).collect()}
    assert keys["items(order_id, order_item_id)"] is False and keys["orders(order_id)"] is True
    lost = {r.prueba: r.huerfanos for r in checks.check_references(broken).collect()}
    assert (lost["items.order_id"], lost["items.product_id"], lost["items.seller_id"]) == (1, 1, 1)
    nulls = {(r.tabla, r.columna): r.nulos for r in checks.check_required(broken).collect()}
    assert nulls["items", "order_item_id"] == 1 and nulls["items", "seller_id"] == 1
    verdict = {r.prueba: r.ok for r in checks.verdict({"claves": checks.check_keys(broken), "sin ok": broken["items"]}).collect()}
    assert verdict == {"claves": False, "sin ok": True}
    with pytest.raises(ValueError, match="order_item_id"):
        checks.require_ok(checks.check_keys(broken))


def test_counts_and_sums(nine, spark):
    rows = {r.tabla: (r.esperado, r.obtenido, r.ok) for r in checks.check_row_counts(nine, {"orders": 3, "items": 5}).collect()}
    assert rows == {"orders": (3, 3, True), "items": (5, 4, False)}
    one, other = (spark.createDataFrame([(v,)], "v double") for v in (100.0, 100.002))
    off = checks.check_sums({"x": (one, "v", other, "v"), "y": (one, "v", one, "v")})
    assert {r.prueba: r.ok for r in off.collect()} == {"x": False, "y": True}


def test_profiles(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 1.0), ("b", None), (None, float("inf"))], "k string, v double"
    )
    assert values(profile.null_profile(df)) == [("k", 1, 25.0), ("v", 1, 25.0)]
    assert values(profile.infinity_profile(df)) == [("v", 1)]
    assert tuple(profile.duplicate_profile(df).first()) == (4, 1)
    assert tuple(profile.grain(df, "k").first())[:2] == (4, 2)
    assert values(profile.value_counts(df, "k")) == [("a", 2, 2 / 3), ("b", 1, 1 / 3)]
    assert values(profile.value_counts(df, "k", keep_null=True))[-1] == (None, 1, 0.25)


def test_describe_matches_pandas(spark):
    df = spark.createDataFrame([(float(i * i), i) for i in range(11)], "a double, b int")
    got = {r.columna: r for r in profile.describe(df, ["a", "b"]).collect()}
    want = df.toPandas().describe()
    for column in ("a", "b"):
        assert [got[column][c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")] == pytest.approx(
            want[column].tolist()
        )


def test_invalid_values(nine, spark):
    bad = full_market(spark, products=[("p1", "a", 0, 1, 1, 1), ("p2", "b", None, 1, 1, 1), ("p3", "c", 1, 1, 1, 1)], payments=[("o1", "x", 0, 1), ("o2", "x", 2, 1)])
    assert tuple(profile.invalid_value_counts(bad["products"], bad["payments"]).first()) == (1, 1, 1)
    assert values(profile.invalid_products(bad["products"]), "product_id") == [("p1",), ("p2",)]
    assert tuple(profile.invalid_value_counts(nine["products"], nine["payments"]).first()) == (0, 0, 0)


def test_seeded_sample_does_not_depend_on_partitions(nine):
    one = values(profile.seeded_sample(nine["orders"].repartition(3), "order_id", 2))
    assert one == values(profile.seeded_sample(nine["orders"].coalesce(1), "order_id", 2)) and len(one) == 2


def test_last_review_per_column(nine):
    rows = by_key(star.review_rollup(nine["reviews"]))
    # the newest score and the newest message come from different reviews
    assert (rows["o1"].review_score, rows["o1"].review_comment_message, rows["o1"].n_reviews) == (5, "tarde", 2)
    # a missing answer time counts as the newest
    assert rows["o2"].review_score == 3 and rows["o2"].review_creation_date == datetime(2017, 7, 16)


def test_fact_orders(spark):
    orders = order_rows() + [("o4", "c1", "canceled", "2018-03-01 10:00:00", None, None, None, "2018-03-20 00:00:00")]
    nine = full_market(spark, orders=orders)
    rows = by_key(star.fact_orders(*[nine[n] for n in ("orders", "customers", "items", "payments", "reviews")]))
    assert {k: r.entrega_tardia for k, r in rows.items()} == {"o1": 0.0, "o2": 1.0, "o3": 0.0, "o4": None}
    assert rows["o2"].dias_retraso == pytest.approx(14 + 10 / 24)
    assert rows["o1"].dias_retraso < 0 and rows["o4"].dias_entrega_total is None
    assert (rows["o1"].pago_total, rows["o1"].n_metodos_pago, rows["o1"].tipo_pago_principal) == (165.0, 2, "credit_card")
    assert rows["o4"].tiene_items is False and rows["o3"].tiene_review is False


def test_dimensions(spark):
    points = [("1", -23.0, -46.0), ("1", -25.0, -46.0), ("1", 50.0, 2.0), (None, -23.0, -46.0)]
    nine = full_market(spark, geolocation=points, products=[("p1", "moveis", 1, 2, 0, 4), ("p2", None, 1, 2, 3, 4), ("p3", "pc_gamer", 1, 1, 1, 1)])
    geo = nine["geolocation"].withColumns({"geolocation_city": F.when(F.col("geolocation_lat") > -24, "b").otherwise("a"), "geolocation_state": F.lit("SP")})
    assert values(star.dim_geolocation(geo), "zip_prefix", "lat", "lng", "ciudad", "estado") == [("1", -24.0, -46.0, "a", "SP")]
    products = by_key(star.dim_products(nine["products"], nine["translation"]), "product_id")
    assert products["p1"].product_category_name_english == "furniture" and products["p1"].product_volume_cm3 == 0
    assert products["p2"].product_category_name == "desconocida" and products["p2"].product_category_name_english == "unknown"
    assert products["p3"].product_category_name_english == "pc_gamer"
    days = star.dim_calendar(nine["orders"]).orderBy("fecha").collect()
    assert len(days) == 393 and days[0].nombre_dia == "Thursday" and days[0].dia_semana == 3
    assert days[-1].anio_mes == "2018-02" and days[-1].trimestre == 1


def exchanges_above(plan, marker: str) -> int:
    """Most exchanges between the root of a physical plan and a leaf that has a column."""
    below = [plan.children().apply(i) for i in range(plan.children().size())]
    if not below:
        return 0 if marker in plan.output().toString() else -100
    return max(exchanges_above(p, marker) for p in below) + (plan.nodeName() == "Exchange")


def test_flat_items_move_once_per_key(nine, spark):
    """Items are exchanged by product, by seller and by order, and keep their rows and columns."""
    flat = star.build_star(nine)["items_flat"]
    old = {name: spark.conf.get(name) for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert exchanges_above(flat.select("*")._jdf.queryExecution().executedPlan(), "shipping_limit_date") == 3
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    assert flat.columns[:4] == ["order_id", "seller_id", "product_id", "customer_id"] and len(flat.columns) == len(set(flat.columns))
    got = values(flat, "order_id", "order_item_id", "customer_unique_id", "seller_state", "product_category_name", "n_items", "monto_item")
    assert [r[:2] + r[3:6] for r in got] == [
        ("o1", 1, "SP", "moveis", 2), ("o1", 2, "RJ", "desconocida", 2), ("o2", 1, "SP", "moveis", 1), ("o3", 1, "RJ", "desconocida", 1)
    ]
    assert [float(r[6]) for r in got] == [110, 55, 120, 58]


def test_star_is_checked_and_exported(nine, spark, tmp_path):
    built = star.build_star(nine)
    assert len(built) == 9 and "pago_total" not in built["items_flat"].columns
    shapes = {r.tabla: r.filas for r in star.export_star(built, nine, str(tmp_path / "star")).collect()}
    assert shapes["fact_orders"] == 3 and shapes["items_flat"] == 4 and shapes["dim_calendario"] == 393


def test_star_as_a_release(nine, spark, tmp_path):
    built, folder = star.build_star(nine), str(tmp_path / "star")
    star.export_star(built, nine, folder, "csv", as_release=True)
    read = releases.read_release(spark, folder)
    assert set(read) == set(built)
    for name in ("fact_orders", "dim_customers"):
        assert values(read[name]) == values(built[name]), name


def test_nothing_is_written_when_a_check_fails(spark, tmp_path):
    doubled = full_market(spark, sellers=[("s1", "01000", "SP"), ("s1", "01000", "RJ"), ("s2", "20000", "RJ")])
    with pytest.raises(ValueError, match="items_flat"):
        star.export_star(star.build_star(doubled), doubled, str(tmp_path / "star"))
    assert not (tmp_path / "star").exists()


def write_csvs(tables, folder, skip=()):
    for name, df in tables.items():
        if name not in skip:
            sinks.write_table(df.coalesce(1), f"{folder}/{name}.csv")


def test_csv_round_trip_keeps_everything(nine, spark, tmp_path):
    write_csvs(nine, tmp_path)
    loaded = readers.load_all_tables(spark, str(tmp_path))
    for name in TABLES:
        assert values(loaded[name]) == values(nine[name]), name
        assert [f.dataType for f in loaded[name].schema] == [k for _, k in TABLES[name].columns]
    zips = values(loaded["sellers"], "seller_zip_code_prefix")
    assert zips == [("01000",), ("20000",)]  # leading zeros survive


def test_ingest_can_be_repeated(nine, spark, tmp_path):
    write_csvs(nine, tmp_path / "csv")
    for _ in range(2):
        counts = readers.ingest(spark, str(tmp_path / "csv"), str(tmp_path / "tables"))
        assert {r.tabla: r.filas for r in counts.collect()}["items"] == 4
    loaded = readers.load_parquet_tables(spark, str(tmp_path / "tables"))
    assert values(loaded["reviews"]) == values(nine["reviews"])


def test_all_missing_files_are_named_at_once(nine, spark, tmp_path):
    write_csvs(nine, tmp_path, skip=("orders", "payments", "geolocation"))
    with pytest.raises(FileNotFoundError) as error:
        readers.load_tables(spark, str(tmp_path))
    assert "orders" in str(error.value) and "payments" in str(error.value)
    with pytest.raises(FileNotFoundError, match="geolocation"):
        readers.load_geolocation(spark, str(tmp_path))


def test_file_names_can_be_given(nine, spark, tmp_path):
    sinks.write_table(nine["sellers"], f"{tmp_path}/vendedores.csv")
    loaded = readers.load_tables(spark, str(tmp_path), ["sellers"], {"sellers": "vendedores.csv"})
    assert loaded["sellers"].count() == 2


def test_reports_read_back(spark, tmp_path):
    report = {"a": 1, "b": [1.5, "é"], "c": {"d": None}}
    sinks.write_report(spark, report, str(tmp_path / "r"))
    assert sinks.read_report(spark, str(tmp_path / "r")) == report


def test_a_release_is_seen_whole_or_not_at_all(nine, spark, tmp_path):
    folder = str(tmp_path / "r")
    assert releases.numbers(spark, folder) == []
    with pytest.raises(FileNotFoundError):
        releases.read_release(spark, folder)
    releases.publish(nine, folder)
    before = releases.read_release(spark, folder)
    lost = nine["payments"].withColumn("payment_type", F.raise_error(F.lit("writer lost")).cast("string"))
    with pytest.raises(Exception, match="writer lost"):
        releases.publish({"customers": nine["customers"].limit(1), "payments": lost}, folder)
    assert releases.numbers(spark, folder) == [1]
    for name, df in releases.read_release(spark, folder).items():
        assert values(df) == values(nine[name]), name
    # a release of one table keeps the others; who has read the first goes on reading it
    shapes = releases.publish({"sellers": nine["sellers"].limit(1)}, folder, "csv")
    assert values(shapes, "tabla", "filas") == [("sellers", 1)]
    after = releases.read_release(spark, folder)
    assert (after["sellers"].count(), after["orders"].count(), before["sellers"].count()) == (1, 3, 2)
    assert values(releases.read_release(spark, folder, 1)["sellers"]) == values(nine["sellers"])
    # a number that is taken is not taken again
    assert not releases._claim(spark, folder, 2, {}) and set(releases.manifest(spark, folder)) == set(TABLES)
    releases.expire(spark, folder, keep=1)
    assert releases.numbers(spark, folder) == [2]
    assert values(releases.read_release(spark, folder)["reviews"]) == values(nine["reviews"])
    with pytest.raises(Exception, match="(?i)not.?found|does not exist"):
        before["sellers"].count()


def test_catalog_view_is_found_by_another_session(nine, spark, tmp_path):
    maker, folder = spark.newSession(), str(tmp_path / "r")
    releases.publish(nine, folder)
    maker.sql(f"CREATE DATABASE mercado LOCATION '{tmp_path / 'db'}'")
    try:
        releases.register_tables(maker, folder, "mercado")
        for _ in range(2):  # replaceable
            view = create_catalog_view(maker, "mercado")
        got, want = spark.newSession().table(view), analytic_view(nine)
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
        assert values(got) == values(want) and want.count() == 3
        # it shows the tables as they are
        releases.publish({"orders": nine["orders"].limit(0)}, folder)
        releases.register_tables(maker, folder, "mercado")
        assert spark.table(view).count() == 0
    finally:
        maker.sql("DROP DATABASE mercado CASCADE")
