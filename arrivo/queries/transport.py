"""Tables carried through files and the catalog: what comes back must be what went in."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arrivo.plans.view import create_analytic_view, create_catalog_view
from arrivo.queries.binding import PERIOD
from arrivo.queries.registry import SQL, register
from arrivo.schemas import TABLES
from arrivo.session import configure, scratch_path
from arrivo.sources import readers, releases, sinks


def typed(b, name: str) -> DataFrame:
    """A bound table in the types of the marketplace schema; ids are text there."""
    return b[name].select(*[F.col(c).cast(kind).alias(c) for c, kind in TABLES[name].columns])


def csv_folder(b, *names: str) -> str:
    """The tables as CSV under the names that the readers look for."""
    folder = scratch_path(b.spark, "csv")
    for name in names:
        sinks.write_table(typed(b, name), f"{folder}/{name}.csv")
    return folder


def csv_orders(b) -> DataFrame:
    return readers.load_tables(b.spark, csv_folder(b, "orders"), ["orders"])["orders"]


def ingested_items(b) -> DataFrame:
    """CSV to Parquet twice, which must be the same as once."""
    source, target = csv_folder(b, "items"), scratch_path(b.spark, "ingested")
    for _ in range(2):
        readers.ingest(b.spark, source, target, ["items"])
    return readers.load_parquet_tables(b.spark, target, ["items"])["items"]


def exported_reviews(b) -> DataFrame:
    """Shapes of exported tables, counted on the written files."""
    tables = {name: b[name] for name in ("reviews", "customers", "payments")}
    return sinks.write_tables(tables, scratch_path(b.spark, "export"))


def catalog_view(b) -> DataFrame:
    create_analytic_view(b, "pedidos_analitica", PERIOD)
    return b.spark.table("pedidos_analitica")


def catalog_sql_view(b) -> DataFrame:
    """The view as SQL text over a release in the catalog, made in one session and read in another."""
    folder, maker = scratch_path(b.spark, "catalog"), configure(b.spark.newSession())
    database = folder.rsplit("/", 1)[-1].replace("-", "_")
    releases.publish({n: b[n] for n in ("orders", "items", "products", "sellers", "customers", "payments")}, folder)
    maker.sql(f"CREATE DATABASE {database} LOCATION '{folder}/database'")
    releases.register_tables(maker, folder, database)
    return b.spark.table(create_catalog_view(maker, database, period=PERIOD))


def released_payments(b) -> DataFrame:
    """Payments of the newest whole release, after a second writer has failed at its second table."""
    folder = scratch_path(b.spark, "release")
    releases.publish({n: b[n] for n in ("customers", "payments")}, folder)
    broken = b["payments"].withColumn("payment_type", F.raise_error(F.lit("lost")).cast("string"))
    try:
        releases.publish({"customers": b["customers"].limit(0), "payments": broken}, folder)
    except Exception as error:
        if "lost" not in str(error):
            raise
    return releases.read_release(b.spark, folder)["payments"]


def text_ids(name: str) -> str:
    kinds = {c: kind.typeName() for c, kind in TABLES[name].columns}
    columns = [f"CAST({c} AS VARCHAR) AS {c}" if kind == "string" else c for c, kind in kinds.items()]
    return f"SELECT {', '.join(columns)} FROM m_{name}"


register("csv_orders", csv_orders, text_ids("orders"))
register("ingested_items", ingested_items, text_ids("items"), real=["price", "freight_value"])
register(
    "exported_shapes",
    exported_reviews,
    " UNION ALL ".join(
        f"SELECT '{n}' AS tabla, count(*) AS filas, {len(TABLES[n].columns)} AS columnas FROM m_{n}"
        for n in ("reviews", "customers", "payments")
    ),
    whole=["columnas"],
)
register("catalog_view", catalog_view)
SQL["catalog_view"] = SQL["analytic_view"]
register("catalog_sql_view", catalog_sql_view)
SQL["catalog_sql_view"] = SQL["analytic_view"]
register("released_payments", released_payments, "SELECT * FROM m_payments", real=["payment_value"], whole=["payment_sequential", "payment_installments"])
