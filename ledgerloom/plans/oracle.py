"""DuckDB counterparts of the adapter views, as named CTEs."""

from __future__ import annotations

M = "DECIMAL(20,2)"

CTES: dict[str, tuple[list[str], str]] = {
    "report": ([], """
SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS id, 'report_' || CAST(year(o_orderdate) AS VARCHAR) || '.pdf' AS filename,
 'consolidato' AS document_type, CAST(year(o_orderdate) AS INT) AS year, CAST(year(o_orderdate) - 1900 AS INT) AS page_count FROM orders"""),
    "metric": (["report"], f"""
SELECT CAST(r.id AS BIGINT) * 1000000 + x.year * 100 + CAST(substr(x.category, 1, 1) AS BIGINT) * 10 + strpos('FOP', x.metric_name) AS id,
 r.id AS document_id, x.year, x.category, substr(x.category, 1, 1) AS code, x.metric_name,
 CASE WHEN r.id = x.year THEN x.own ELSE x.restated END AS value, 'EUR' AS unit,
 CAST(CAST(substr(x.category, 1, 1) AS INT) * 10 + strpos('FOP', x.metric_name) AS INT) AS source_page
FROM (SELECT CAST(year(o_orderdate) AS INT) AS year, o_orderpriority AS category, o_orderstatus AS metric_name,
  sum(CAST(o_totalprice AS {M})) AS own, sum(CAST(floor(o_totalprice) AS {M})) AS restated FROM orders GROUP BY 1, 2, 3) x
JOIN report r ON r.id = x.year OR r.id = x.year + 1"""),
    "geo": ([], """
SELECT o.*, c.*, n.*, g.*, CAST(year(o_orderdate) AS INT) AS year FROM orders o JOIN customer c ON o_custkey = c_custkey
JOIN nation n ON c_nationkey = n_nationkey JOIN region g ON n_regionkey = r_regionkey"""),
    "leaf": (["geo"], f"""
SELECT year, CASE WHEN o_orderstatus = 'F' THEN 'entrata' ELSE 'spesa' END AS kind, lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS liv1_code, r_name AS liv1_name,
 CAST(n_nationkey AS VARCHAR) AS liv2_code, n_name AS liv2_name, CASE WHEN c_acctbal >= 0 THEN substr(c_mktsegment, 1, 2) END AS liv3_code,
 CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS liv3_name, lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS capitolo_code, c_name AS denominazione,
 CASE WHEN o_orderstatus = 'F' THEN 'accertamenti' ELSE 'impegni' END AS measure,
 sum(CASE WHEN o_orderpriority = '1-URGENT' THEN -CAST(o_totalprice AS {M}) ELSE CAST(o_totalprice AS {M}) END) AS value
FROM geo GROUP BY ALL"""),
    "member": (["geo"], f"""
SELECT n_name AS comune, r_name AS region, year, c_mktsegment AS code, sum(CAST(o_totalprice AS {M})) AS value
FROM geo WHERE NOT (r_name = 'EUROPE' AND c_mktsegment = 'BUILDING') GROUP BY ALL"""),
    "population": (["geo"], """
SELECT n_name AS comune, year, CAST(count(DISTINCT o_custkey) AS INT) AS residenti FROM geo WHERE n_name <> 'NATION_7' GROUP BY ALL"""),
    "contract": ([], f"""
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS cig, CAST(year(o_orderdate) AS INT) AS anno, p_name AS oggetto, o_orderpriority AS struttura,
 CASE WHEN s_acctbal >= 0 THEN s_name END AS aggiudicatario, n_partecipanti, importo_aggiudicazione, importo_liquidato
FROM (SELECT l_orderkey, l_suppkey, max(l_partkey) AS part, CAST(count(*) AS INT) AS n_partecipanti, sum(CAST(l_extendedprice AS {M})) AS importo_aggiudicazione,
  sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS {M}) END) AS importo_liquidato FROM lineitem GROUP BY 1, 2)
JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON part = p_partkey"""),
    "movement": ([], f"""
SELECT user_id, event_type, sum(CASE WHEN day(ts) <= 15 THEN CAST(value AS {M}) ELSE 0 END) AS inizio,
 sum(CASE WHEN day(ts) > 15 THEN CAST(value AS {M}) ELSE 0 END) AS variazione,
 sum(CAST(value AS {M})) + CASE WHEN max(CAST(value AS {M})) > 400 THEN 1 ELSE 0 END AS fine FROM events GROUP BY user_id, event_type"""),
    "note": (["movement"], """
SELECT user_id, event_type, 'inizio' AS period, inizio AS value FROM movement UNION ALL SELECT user_id, event_type, 'variazione', variazione FROM movement
UNION ALL SELECT user_id, event_type, 'fine', fine FROM movement"""),
    "series": ([], f"""
SELECT year, sum(added) OVER (ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS opening, added,
 sum(added) OVER (ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS closing, people
FROM (SELECT CAST(year(o_orderdate) AS INT) AS year, sum(CAST(o_totalprice AS {M})) AS added, count(DISTINCT o_custkey) AS people FROM orders GROUP BY 1)"""),
    "rawname": ([], """
SELECT s_suppkey AS id, p_name || CASE WHEN s_nationkey < 8 THEN ' (società di Gear)' WHEN s_nationkey < 16 THEN ' S.p.A.' ELSE '' END AS raw_name
FROM supplier JOIN part ON p_partkey = s_suppkey"""),
    "canonical": (["rawname"], """
SELECT id, raw_name, CASE WHEN up LIKE '%WIDGET%' THEN 'widget_spa' WHEN up LIKE '%GEAR%' THEN 'gear_group' WHEN up LIKE '%BOLT%' THEN 'bolt_works'
  WHEN up LIKE '% ROD%' THEN 'rod_srl' WHEN up LIKE '%RING%' THEN 'ring_house' ELSE trim(regexp_replace(lower(trim(split_part(up, ' S.P.A', 1))), '[^a-z0-9]+', '_', 'g'), '_') END AS canonical_slug,
 CASE WHEN up LIKE '%WIDGET%' THEN 'Widget S.p.A.' WHEN up LIKE '%GEAR%' THEN 'Gear Group' WHEN up LIKE '%BOLT%' THEN 'Bolt Works'
  WHEN up LIKE '% ROD%' THEN 'Rod S.r.l.' WHEN up LIKE '%RING%' THEN 'Ring House' ELSE trim(raw_name) END AS canonical_name
FROM (SELECT *, upper(strip_accents(trim(regexp_replace(raw_name, '\\([^)]*\\)', ' ', 'g')))) AS up FROM rawname)"""),
    "supplier_year": (["canonical"], f"""
SELECT c.*, x.* FROM (SELECT l_suppkey, CAST(year(l_shipdate) AS INT) AS year, sum(CAST(l_extendedprice AS {M})) AS valore, sum(CAST(l_quantity AS {M})) AS quantita,
  CAST(CAST(max(l_discount) AS DECIMAL(7,4)) * 100 AS {M}) AS sconto, min(l_linenumber) AS source_page FROM lineitem GROUP BY 1, 2) x JOIN canonical c ON c.id = x.l_suppkey"""),
    "entity": (["supplier_year"], """
SELECT year AS document_id, year, raw_name AS name, canonical_slug, canonical_name, sconto AS ownership_percentage,
 CASE WHEN contains(upper(raw_name), 'S.P.A') THEN 'società' ELSE 'altro' END AS entity_type, source_page FROM supplier_year"""),
    "entity_metric": (["supplier_year"], """
SELECT id AS entity_id, year AS document_id, year, raw_name AS entity_name, canonical_slug, canonical_name, m.source, m.metric_name, m.value, m.unit, source_page
FROM supplier_year, LATERAL (VALUES ('valutazione', 'valore', valore, 'EUR'), ('personale', 'quantita', quantita, 'EUR'), ('valutazione', 'sconto', sconto, 'PCT')) m(source, metric_name, value, unit)"""),
    "line": ([], f"""
SELECT x.*, p_name AS name FROM (SELECT l_orderkey AS doc, l_linenumber AS pos, sum(CAST(l_extendedprice AS {M})) AS amount, sum(CAST(l_quantity AS {M}) * 1000) AS prior,
 max(l_returnflag) AS flag, max(l_linestatus) AS status, max(l_partkey) AS part FROM lineitem GROUP BY 1, 2) x JOIN part ON part = p_partkey"""),
    "statement": ([], f"""
WITH items AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INT) AS year,
  CASE l_returnflag WHEN 'A' THEN 'stato_patrimoniale_attivo' WHEN 'N' THEN 'stato_patrimoniale_passivo' ELSE 'conto_economico' END AS category,
  l_linenumber AS seq, sum(CAST(l_extendedprice AS {M})) AS value FROM lineitem GROUP BY ALL),
 assets AS (SELECT l_suppkey, year, sum(value) AS a, sum(value) + CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END AS p
  FROM items JOIN supplier ON l_suppkey = s_suppkey WHERE category = 'stato_patrimoniale_attivo' GROUP BY l_suppkey, year, s_acctbal),
 rows AS (SELECT l_suppkey, year, category, seq, seq || ')' AS code, 'Voce ' || seq AS name, value, FALSE AS is_total, CASE WHEN seq = 7 THEN 'socio' END AS related_party FROM items
  UNION ALL SELECT l_suppkey, year, 'stato_patrimoniale_attivo', 99, NULL, 'TOTALE ATTIVO', a, TRUE, NULL FROM assets
  UNION ALL SELECT l_suppkey, year, 'stato_patrimoniale_passivo', 99, NULL, 'TOTALE PASSIVO', p, TRUE, NULL FROM assets)
SELECT 'supplier_' || l_suppkey AS entity_slug, 'Supplier ' || l_suppkey AS entity_name, year, category, seq, code, name, value, is_total, related_party FROM rows"""),
}


def with_views(body: str, *names: str) -> str:
    """The query with the adapter CTEs it uses (and theirs) in front."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for parent in CTES[name][0]:
            visit(parent)
        order.append(name)

    for name in names:
        visit(name)
    head = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in order)
    if not head:
        return body
    # A body that opens with CTEs of its own continues the same list.
    return f"WITH {head},\n{body[4:].lstrip()}" if body.startswith("WITH ") else f"WITH {head}\n{body}"
