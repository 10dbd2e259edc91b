"""The query surface over a small stored ledger."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.ledger import Ledger
from ledgerloom.sources import load


@pytest.fixture(scope="module")
def ledger(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("ledger"))

    def store(name, schema, ddl, data, part="year"):
        df = spark.createDataFrame(data, ddl)
        load.append_typed(df.withColumn("_p", F.lit(1)), f"{root}/{name}", schema, part)

    store("documents", schemas.DOCUMENTS, "id int, filename string, year int", [(1, "a.pdf", 2020), (2, "b.pdf", 2021)])
    store(
        "metrics", schemas.METRICS, "id int, document_id int, year int, category string, code string, metric_name string, value decimal(20,2), source_page int",
        [(1, 1, 2020, "att", "A", "Totale", D("10"), 3), (2, 2, 2020, "att", "A", "Totale", D("11"), 4), (3, 2, 2021, "att", None, "TOTALE", D("12"), 5), (4, 9, 2021, "att", "B", "Orfano", D("1"), 5)],
    )
    store(
        "entity_metrics", schemas.ENTITY_METRICS, "document_id int, year int, entity_name string, canonical_slug string, canonical_name string, source string, metric_name string, value decimal(20,4)",
        [(1, 2020, "SMAT spa", "smat", "SMAT", "personale", "spesa", D("5")), (2, 2021, "SMAT", "smat", "SMAT", "personale", "spesa", D("6"))],
    )
    store(
        "leaves", schemas.RENDICONTO_CAPITOLI, "year int, kind string, liv1_code string, liv1_name string, liv2_code string, capitolo_code string, denominazione string, measure string, value decimal(20,2)",
        [(2020, "spesa", "01", "Servizi", "1", "11", "Carta", "impegni", D("5")), (2020, "spesa", "01", "Servizi", "1", "12", "Sedie", "impegni", D("7")), (2021, "spesa", "01", "Servizi", "1", "11", "Carta", "impegni", D("9"))],
    )
    store(
        "contracts", schemas.CONTRATTI, "cig string, anno int, oggetto string, aggiudicatario string, importo_aggiudicazione decimal(20,2), importo_liquidato decimal(20,2)",
        [("Z1", 2020, "Carta", "Rossi", D("5"), None), ("Z2", 2020, "Penne", None, D("8"), D("3")), ("Z3", 2021, "carta", "Rossi", None, D("9"))], part="anno",
    )
    return Ledger(spark, root)


def one(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_metrics_carry_provenance(ledger):
    assert one(ledger.metrics(), "id", "source_document") == [(3, "b.pdf"), (1, "a.pdf"), (2, "b.pdf")]
    assert one(ledger.metrics(query="TOT", year=2020, limit=1, offset=1), "id") == [(2,)]
    assert one(ledger.metric_series("totale"), "year", "value", "source_document") == [(2020, 10.0, "a.pdf"), (2021, 12.0, "b.pdf")]
    assert one(ledger.years(), "year") == [(2020,), (2021,)]


def test_entities_found_only_in_metrics(ledger):
    assert one(ledger.search("smat")["entities"], "canonical_slug", "entity_type") == [("smat", None)]
    assert one(ledger.entity_directory(), "canonical_slug", "n_years") == [("smat", 2)]
    assert one(ledger.entity_metrics_over_years("smat"), "metric_name") == [("spesa",)]
    assert one(ledger.entity_metric_series("smat", "spesa"), "year", "value") == [(2020, 5.0), (2021, 6.0)]


def test_leaves(ledger):
    assert one(ledger.leaves("spesa", 2020, "impegni", limit=1), "capitolo_code", "value") == [("12", 7.0)]
    assert one(ledger.leaf_series("spesa", "impegni", liv1="01"), "year", "value") == [(2020, 12.0), (2021, 9.0)]
    assert one(ledger.leaf_items("spesa", "01"), "code", "name") == [("11", "Carta"), ("12", "Sedie")]
    assert one(ledger.hierarchy("spesa", 2020, "impegni"), "liv1_code", "liv3_code", "value") == [("01", None, 12.0)]


def test_contracts(ledger):
    assert one(ledger.contracts(search="CARTA"), "cig") == [("Z1",), ("Z3",)]
    assert one(ledger.contracts(order_by="importo_liquidato"), "cig") == [("Z3",), ("Z2",), ("Z1",)]
    assert one(ledger.contract_summary(), "n", "tot_aggiudicato", "n_fornitori") == [(3, 13.0, 1)]
    assert one(ledger.top_suppliers(2020), "aggiudicatario", "importo") == [(None, 8.0), ("Rossi", 5.0)]


def test_missing_tables_are_empty(ledger):
    assert not ledger.has("debt") and ledger.has("metrics")
    assert ledger.debt("x").count() == 0 and ledger.members("T").count() == 0 and ledger.note_items().count() == 0
