"""Fixed schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DecimalType, IntegerType, StringType, StructField, StructType, TimestampType

# Table, column and type names of the data model.
DOCUMENTS = StructType(
    [
        StructField("id", IntegerType()),
        StructField("filename", StringType()),
        StructField("checksum", StringType()),
        StructField("document_type", StringType()),
        StructField("year", IntegerType()),
        StructField("upload_timestamp", TimestampType()),
        StructField("page_count", IntegerType()),
    ]
)
TABLES = StructType(
    [
        StructField("id", IntegerType()),
        StructField("document_id", IntegerType()),
        StructField("page", IntegerType()),
        StructField("table_type", StringType()),
        StructField("raw_json", StringType()),
    ]
)
METRICS = StructType(
    [
        StructField("id", IntegerType()),
        StructField("document_id", IntegerType()),
        StructField("year", IntegerType()),
        StructField("category", StringType()),
        StructField("code", StringType()),
        StructField("metric_name", StringType()),
        StructField("value", DecimalType(20, 2)),
        StructField("unit", StringType()),
        StructField("source_page", IntegerType()),
    ]
)
ENTITIES = StructType(
    [
        StructField("id", IntegerType()),
        StructField("document_id", IntegerType()),
        StructField("year", IntegerType()),
        StructField("name", StringType()),
        StructField("canonical_slug", StringType()),
        StructField("canonical_name", StringType()),
        StructField("ownership_percentage", DecimalType(7, 4)),
        StructField("consolidation_method", StringType()),
        StructField("entity_type", StringType()),
        StructField("source_page", IntegerType()),
    ]
)
ENTITY_METRICS = StructType(
    [
        StructField("id", IntegerType()),
        StructField("document_id", IntegerType()),
        StructField("year", IntegerType()),
        StructField("entity_name", StringType()),
        StructField("canonical_slug", StringType()),
        StructField("canonical_name", StringType()),
        StructField("source", StringType()),
        StructField("metric_name", StringType()),
        StructField("value", DecimalType(20, 4)),
        StructField("unit", StringType()),
        StructField("note", StringType()),
        StructField("source_page", IntegerType()),
    ]
)
NOTE_ITEMS = StructType(
    [
        StructField("id", IntegerType()),
        StructField("document_id", IntegerType()),
        StructField("year", IntegerType()),
        StructField("source_page", IntegerType()),
        StructField("table_index", IntegerType()),
        StructField("heading", StringType()),
        StructField("kind", StringType()),
        StructField("voce", StringType()),
        StructField("period", StringType()),
        StructField("value", DecimalType(20, 2)),
        StructField("unit", StringType()),
    ]
)
RENDICONTO = StructType(
    [
        StructField("id", IntegerType()),
        StructField("document_id", IntegerType()),
        StructField("year", IntegerType()),
        StructField("kind", StringType()),
        StructField("level", StringType()),
        StructField("code", StringType()),
        StructField("name", StringType()),
        StructField("measure", StringType()),
        StructField("value", DecimalType(20, 2)),
        StructField("unit", StringType()),
        StructField("source_page", IntegerType()),
    ]
)
RENDICONTO_CAPITOLI = StructType(
    [
        StructField("id", IntegerType()),
        StructField("document_id", IntegerType()),
        StructField("year", IntegerType()),
        StructField("kind", StringType()),
        StructField("sezione", StringType()),
        StructField("liv1_code", StringType()),
        StructField("liv1_name", StringType()),
        StructField("liv2_code", StringType()),
        StructField("liv2_name", StringType()),
        StructField("liv3_code", StringType()),
        StructField("liv3_name", StringType()),
        StructField("capitolo_code", StringType()),
        StructField("denominazione", StringType()),
        StructField("measure", StringType()),
        StructField("value", DecimalType(20, 2)),
        StructField("unit", StringType()),
        StructField("source_page", IntegerType()),
    ]
)
DEBITO = StructType(
    [
        StructField("id", IntegerType()),
        StructField("year", IntegerType()),
        StructField("measure", StringType()),
        StructField("value", DecimalType(20, 2)),
        StructField("unit", StringType()),
        StructField("source", StringType()),
    ]
)
RENDICONTO_COMUNI = StructType(
    [
        StructField("id", IntegerType()),
        StructField("comune", StringType()),
        StructField("region", StringType()),
        StructField("year", IntegerType()),
        StructField("kind", StringType()),
        StructField("level", StringType()),
        StructField("code", StringType()),
        StructField("name", StringType()),
        StructField("measure", StringType()),
        StructField("value", DecimalType(20, 2)),
        StructField("unit", StringType()),
        StructField("source", StringType()),
    ]
)
POPOLAZIONE = StructType(
    [
        StructField("comune", StringType()),
        StructField("year", IntegerType()),
        StructField("residenti", IntegerType()),
        StructField("source", StringType()),
    ]
)
ENTITY_STATEMENTS = StructType(
    [
        StructField("id", IntegerType()),
        StructField("entity_slug", StringType()),
        StructField("entity_name", StringType()),
        StructField("year", IntegerType()),
        StructField("category", StringType()),
        StructField("seq", IntegerType()),
        StructField("code", StringType()),
        StructField("name", StringType()),
        StructField("value", DecimalType(20, 2)),
        StructField("unit", StringType()),
        StructField("is_total", BooleanType()),
        StructField("related_party", StringType()),
        StructField("source_document", StringType()),
        StructField("source_page", IntegerType()),
    ]
)
CONTRATTI = StructType(
    [
        StructField("id", IntegerType()),
        StructField("cig", StringType()),
        StructField("anno", IntegerType()),
        StructField("oggetto", StringType()),
        StructField("struttura", StringType()),
        StructField("scelta_contraente", StringType()),
        StructField("aggiudicatario", StringType()),
        StructField("aggiudicatario_cf", StringType()),
        StructField("n_partecipanti", IntegerType()),
        StructField("importo_aggiudicazione", DecimalType(20, 2)),
        StructField("importo_liquidato", DecimalType(20, 2)),
        StructField("data_inizio", StringType()),
        StructField("data_ultimazione", StringType()),
        StructField("capitolo_code", StringType()),
        StructField("source_document", StringType()),
    ]
)
