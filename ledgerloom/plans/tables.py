"""The driver's tables in the shapes of the public-accounts model.

Each method is one adapter view; nothing is read until a query uses it, and
Spark prunes the columns a query does not need.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom import presets
from ledgerloom.functions.text import classify_entity
from ledgerloom.operators.entities import canonicalize

MONEY = "decimal(20,2)"

# Registry for the part nouns of the test tables; anvil, plate and gizmo are
# left out so that the fallback slug is used too.
REGISTRY = [
    ("widget_spa", "Widget S.p.A.", r"\bWIDGET\b"),
    ("gear_group", "Gear Group", r"\bGEAR\b"),
    ("bolt_works", "Bolt Works", r"\bBOLT\b"),
    ("rod_srl", "Rod S.r.l.", r"\bROD\b"),
    ("ring_house", "Ring House", r"RING"),
]


def money(column: str) -> Column:
    return F.col(column).cast(MONEY)


class Tables:
    """Adapter views over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").withColumn("year", F.year("o_orderdate"))

    @cached_property
    def report(self) -> DataFrame:
        """Document registry: one report per order year."""
        return self.orders.select("year").distinct().select(
            F.col("year").alias("id"),
            F.concat(F.lit("report_"), F.col("year").cast("string"), F.lit(".pdf")).alias("filename"),
            F.lit("consolidato").alias("document_type"),
            "year",
            (F.col("year") - 1900).alias("page_count"),
        )

    @cached_property
    def metric(self) -> DataFrame:
        """Metric lines: each year in its own report and, in whole units, in the next."""
        sums = self.orders.groupBy("year", "o_orderpriority", "o_orderstatus").agg(
            F.sum(money("o_totalprice")).alias("own"),
            F.sum(F.floor("o_totalprice").cast(MONEY)).alias("restated"),
        )
        versions = F.array(
            F.struct(F.col("year").alias("document_id"), F.col("own").alias("value")),
            F.struct((F.col("year") + 1).alias("document_id"), F.col("restated").alias("value")),
        )
        rows = sums.select("year", "o_orderpriority", "o_orderstatus", F.inline(versions))
        known = self.report.select(F.col("id").alias("document_id"))
        status = F.expr("instr('FOP', o_orderstatus)")
        digit = F.substring("o_orderpriority", 1, 1)
        return rows.join(known, "document_id", "left_semi").select(
            (
                F.col("document_id").cast("bigint") * 1_000_000
                + F.col("year") * 100
                + digit.cast("bigint") * 10
                + status
            ).alias("id"),
            "document_id",
            "year",
            F.col("o_orderpriority").alias("category"),
            digit.alias("code"),
            F.col("o_orderstatus").alias("metric_name"),
            "value",
            F.lit("EUR").alias("unit"),
            (digit.cast("int") * 10 + status).alias("source_page"),
        )

    @cached_property
    def order_geo(self) -> DataFrame:
        """Orders with their customer, nation and region."""
        return (
            self.orders.join(self.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )

    @cached_property
    def leaf(self) -> DataFrame:
        """Chapters: region > nation > segment > customer; urgent orders are reversals.

        Customers in debt have no third level.
        """
        kind = F.when(F.col("o_orderstatus") == "F", "entrata").otherwise("spesa")
        amount = F.when(F.col("o_orderpriority") == "1-URGENT", -money("o_totalprice")).otherwise(money("o_totalprice"))
        # Sum per customer first; the hierarchy is joined to the sums.
        per_customer = self.orders.groupBy("year", kind.alias("kind"), "o_custkey").agg(F.sum(amount).alias("value"))
        level3 = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
        return (
            per_customer.join(self.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                "year",
                "kind",
                F.lpad(F.col("r_regionkey").cast("string"), 2, "0").alias("liv1_code"),
                F.col("r_name").alias("liv1_name"),
                F.col("n_nationkey").cast("string").alias("liv2_code"),
                F.col("n_name").alias("liv2_name"),
                F.substring(level3, 1, 2).alias("liv3_code"),
                level3.alias("liv3_name"),
                F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("capitolo_code"),
                F.col("c_name").alias("denominazione"),
                F.when(F.col("kind") == "spesa", "impegni").otherwise("accertamenti").alias("measure"),
                "value",
            )
        )

    @cached_property
    def member(self) -> DataFrame:
        """Comparison cities: nation by segment; European ones report no BUILDING."""
        reported = ~((F.col("r_name") == "EUROPE") & (F.col("c_mktsegment") == "BUILDING"))
        return (
            self.order_geo.where(reported)
            .groupBy(F.col("n_name").alias("comune"), F.col("r_name").alias("region"), "year", F.col("c_mktsegment").alias("code"))
            .agg(F.sum(money("o_totalprice")).alias("value"))
        )

    @cached_property
    def population(self) -> DataFrame:
        """Residents per city and year; one city has none on record."""
        return (
            self.order_geo.where(F.col("n_name") != "NATION_7")
            .groupBy(F.col("n_name").alias("comune"), "year")
            .agg(F.countDistinct("o_custkey").cast("int").alias("residenti"))
        )

    @cached_property
    def contract(self) -> DataFrame:
        """Contracts: one per order and supplier, named by their largest part.

        Suppliers in debt are unnamed. Lines are summed before anything is
        joined, so the joins move contracts and not lines.
        """
        price = money("l_extendedprice")
        sums = self.raw("lineitem").groupBy("l_orderkey", "l_suppkey").agg(
            F.max("l_partkey").alias("part"),
            F.count("*").cast("int").alias("n_partecipanti"),
            F.sum(price).alias("importo_aggiudicazione"),
            F.sum(F.when(F.col("l_linestatus") == "F", price)).alias("importo_liquidato"),
        )
        return (
            sums.join(self.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.raw("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.raw("part"), F.col("part") == F.col("p_partkey"))
            .select(
                F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string")).alias("cig"),
                F.col("year").alias("anno"),
                F.col("p_name").alias("oggetto"),
                F.col("o_orderpriority").alias("struttura"),
                F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("aggiudicatario"),
                "n_partecipanti",
                "importo_aggiudicazione",
                "importo_liquidato",
            )
        )

    @cached_property
    def movement(self) -> DataFrame:
        """Movements of a month; lines with a value above 400 are off by one."""
        value = money("value")
        zero = F.lit(0).cast(MONEY)
        return self.raw("events").groupBy("user_id", "event_type").agg(
            F.sum(F.when(F.day("ts") <= 15, value).otherwise(zero)).alias("inizio"),
            F.sum(F.when(F.day("ts") > 15, value).otherwise(zero)).alias("variazione"),
            (F.sum(value) + F.when(F.max(value) > 400, 1).otherwise(0)).alias("fine"),
        )

    @cached_property
    def note(self) -> DataFrame:
        """Movements as long notes items."""
        return self.movement.unpivot(["user_id", "event_type"], ["inizio", "variazione", "fine"], "period", "value")

    @cached_property
    def series(self) -> DataFrame:
        """Debt series over the few order years."""
        yearly = self.orders.groupBy("year").agg(F.sum(money("o_totalprice")).alias("added"), F.countDistinct("o_custkey").alias("people"))
        # One row per year is all this un-partitioned window sees.
        so_far = Window.orderBy("year")
        return yearly.select(
            "year",
            F.sum("added").over(so_far.rowsBetween(Window.unboundedPreceding, -1)).alias("opening"),
            "added",
            F.sum("added").over(so_far.rowsBetween(Window.unboundedPreceding, 0)).alias("closing"),
            "people",
        )

    @cached_property
    def rawname(self) -> DataFrame:
        """Raw entity names with parentheticals, accents and legal suffixes."""
        suffix = (
            F.when(F.col("s_nationkey") < 8, " (società di Gear)")
            .when(F.col("s_nationkey") < 16, " S.p.A.")
            .otherwise("")
        )
        return self.raw("supplier").join(self.raw("part"), F.col("p_partkey") == F.col("s_suppkey")).select(
            F.col("s_suppkey").alias("id"), F.concat("p_name", suffix).alias("raw_name")
        )

    @cached_property
    def supplier_year(self) -> DataFrame:
        """Yearly figures of every supplier with its raw and canonical name."""
        sums = self.raw("lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
            F.sum(money("l_extendedprice")).alias("valore"),
            F.sum(money("l_quantity")).alias("quantita"),
            (F.max("l_discount").cast("decimal(7,4)") * 100).cast(MONEY).alias("sconto"),
            F.min("l_linenumber").alias("source_page"),
        )
        return sums.join(canonicalize(self.rawname, "raw_name", REGISTRY), F.col("l_suppkey") == F.col("id"))

    @cached_property
    def entity(self) -> DataFrame:
        return self.supplier_year.select(
            F.col("year").alias("document_id"),
            "year",
            F.col("raw_name").alias("name"),
            "canonical_slug",
            "canonical_name",
            F.col("sconto").alias("ownership_percentage"),
            classify_entity(F.col("raw_name")).alias("entity_type"),
            "source_page",
        )

    @cached_property
    def entity_metric(self) -> DataFrame:
        long = self.supplier_year.select(
            "id", "year", "raw_name", "canonical_slug", "canonical_name", "source_page",
            *[F.col(c).cast("decimal(30,2)").alias(c) for c in ("valore", "quantita", "sconto")],
        ).unpivot(
            ["id", "year", "raw_name", "canonical_slug", "canonical_name", "source_page"],
            ["valore", "quantita", "sconto"],
            "metric_name",
            "value",
        )
        return long.select(
            F.col("id").alias("entity_id"),
            F.col("year").alias("document_id"),
            "year",
            F.col("raw_name").alias("entity_name"),
            "canonical_slug",
            "canonical_name",
            F.when(F.col("metric_name") == "quantita", "personale").otherwise("valutazione").alias("source"),
            "metric_name",
            "value",
            F.when(F.col("metric_name") == "sconto", "PCT").otherwise("EUR").alias("unit"),
            "source_page",
        )

    @cached_property
    def line(self) -> DataFrame:
        """Statement lines: one per order and line number, named by their largest part.

        Flags are carried as character codes, which keeps the grouping a hash
        aggregate; the part name is joined to the sums.
        """
        sums = (
            self.raw("lineitem")
            .groupBy(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("pos"))
            .agg(
                F.sum(money("l_extendedprice")).alias("amount"),
                F.sum((money("l_quantity") * 1000).cast(MONEY)).alias("prior"),
                F.max(F.ascii("l_returnflag")).alias("flag"),
                F.max(F.ascii("l_linestatus")).alias("status"),
                F.max("l_partkey").alias("part"),
            )
        )
        return sums.join(self.raw("part"), F.col("part") == F.col("p_partkey")).select(
            "doc", "pos", "amount", "prior", F.char("flag").alias("flag"), F.char("status").alias("status"),
            F.col("p_name").alias("name"), "part",
        )

    @cached_property
    def statement(self) -> DataFrame:
        """Entity statements with their totals; suppliers in debt do not balance."""
        category = (
            F.when(F.col("l_returnflag") == "A", presets.ASSETS)
            .when(F.col("l_returnflag") == "N", presets.LIABILITIES)
            .otherwise(presets.INCOME)
        )
        items = self.raw("lineitem").groupBy(
            "l_suppkey", F.year("l_shipdate").alias("year"), category.alias("category"), F.col("l_linenumber").alias("seq")
        ).agg(F.sum(money("l_extendedprice")).alias("value"))
        named = items.select(
            "l_suppkey", "year", "category", "seq",
            F.concat(F.col("seq").cast("string"), F.lit(")")).alias("code"),
            F.concat(F.lit("Voce "), F.col("seq").cast("string")).alias("name"),
            F.col("value").cast("decimal(30,2)").alias("value"),
            F.lit(False).alias("is_total"),
            F.when(F.col("seq") == 7, "socio").alias("related_party"),
        )
        assets = items.where(F.col("category") == presets.ASSETS).groupBy("l_suppkey", "year").agg(F.sum("value").alias("assets"))
        owed = assets.join(self.raw("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(
            "l_suppkey", "year", "assets", (F.col("assets") + F.when(F.col("s_acctbal") < 0, 1).otherwise(0)).alias("owed")
        )
        pair = F.array(
            F.struct(F.lit(presets.ASSETS).alias("category"), F.lit("TOTALE ATTIVO").alias("name"), F.col("assets").cast("decimal(30,2)").alias("value")),
            F.struct(F.lit(presets.LIABILITIES).alias("category"), F.lit("TOTALE PASSIVO").alias("name"), F.col("owed").cast("decimal(30,2)").alias("value")),
        )
        totals = owed.select("l_suppkey", "year", F.inline(pair)).select(
            "l_suppkey", "year", "category", F.lit(99).alias("seq"), F.lit(None).cast("string").alias("code"), "name", "value",
            F.lit(True).alias("is_total"), F.lit(None).cast("string").alias("related_party"),
        )
        return named.unionByName(totals).select(
            F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string")).alias("entity_slug"),
            F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")).alias("entity_name"),
            "year", "category", "seq", "code", "name", "value", "is_total", "related_party",
        )
