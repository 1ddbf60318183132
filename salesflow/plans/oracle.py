"""Equivalent DuckDB SQL of each registered query (tables are pre-registered views).

Money sums are written the plain SQL way, ``SUM(CAST(x AS DECIMAL(38,10)))``; the Spark side sums
whole parts and decimals as integers, which gives the same exact result. The sum goes to DOUBLE by way of its
digits, which rounds once.
"""

from __future__ import annotations

V1 = ("(SELECT event_id AS id_transaccion, user_id % 100 + 1 AS tienda_id, "
      "CASE WHEN event_type = 'error' THEN -value ELSE value END AS monto, ts AS fecha FROM events)")
V2 = ("(SELECT l_orderkey * 10 + l_linenumber AS id_transaccion, l_suppkey AS tienda_id, "
      "l_partkey AS producto_id, l_extendedprice AS monto, l_shipdate AS fecha FROM lineitem)")
V3 = ("(SELECT o_orderkey AS id_transaccion, o_custkey % 100 + 1 AS tienda_id, "
      "o_totalprice AS monto, o_orderdate AS fecha FROM orders)")
V3_BRONZE = ("SELECT o_orderkey AS id_transaccion, CAST(o_custkey % 100 + 1 AS INTEGER) AS tienda_id, "
             "o_totalprice AS monto, o_orderdate AS fecha FROM orders")
TS_TEXT = "'%Y-%m-%d %H:%M:%S.%f'"


def money(x: str) -> str:
    return f"CAST(CAST(SUM(CAST({x} AS DECIMAL(38,10))) AS VARCHAR) AS DOUBLE)"


def silver(src: str) -> str:
    return (f"(SELECT id_transaccion AS venta_id, tienda_id, monto, fecha AS fecha_venta, "
            f"CAST(year(fecha) AS INTEGER) AS anio_venta, CAST(month(fecha) AS INTEGER) AS mes_venta, "
            f"CAST(day(fecha) AS INTEGER) AS dia_venta, CAST(dayofweek(fecha) + 1 AS INTEGER) AS dia_semana_venta "
            f"FROM {src} WHERE monto > 0)")


def gold(silver_src: str, store: str = "tienda_id") -> str:
    return (f"SELECT {store} AS tienda_id, {money('monto')} AS monto_total_ventas, "
            f"COUNT(venta_id) AS numero_de_transacciones, "
            f"{money('monto')} / COUNT(monto) AS monto_promedio_por_transaccion "
            f"FROM {silver_src} GROUP BY {store} ORDER BY 1")


def decoded_events() -> str:
    return ("SELECT CAST(event_id AS VARCHAR) AS id_transaccion, CAST(user_id % 100 + 1 AS VARCHAR) AS tienda_id, "
            "CAST(NULL AS VARCHAR) AS producto_id, "
            "CASE WHEN event_type = 'error' THEN -value ELSE value END AS monto, ts AS fecha FROM events")


def flagship(src: str, least: float = 100) -> str:
    return (f"SELECT tienda_id, {money('monto')} AS monto_total, {money('monto')} / COUNT(monto) AS monto_promedio "
            f"FROM {src} WHERE monto > {least} GROUP BY tienda_id ORDER BY tienda_id")


def _dq_report(src: str = V2) -> str:
    s, g = silver(src), f"({gold(silver(src))})"
    parts = [f"SELECT 'silver_sales' AS model, '{c}' AS column_name, 'not_null' AS test, "
             f"COUNT(*) FILTER (WHERE {c} IS NULL) AS failures FROM {s}"
             for c in ("venta_id", "tienda_id", "monto", "fecha_venta")]
    parts.append("SELECT 'gold_store_sales', 'tienda_id', 'unique', COUNT(*) FROM "
                 f"(SELECT tienda_id FROM {g} WHERE tienda_id IS NOT NULL GROUP BY tienda_id HAVING COUNT(*) > 1)")
    parts += [f"SELECT 'gold_store_sales', '{c}', 'not_null', COUNT(*) FILTER (WHERE {c} IS NULL) FROM {g}"
              for c in ("tienda_id", "monto_total_ventas", "numero_de_transacciones",
                        "monto_promedio_por_transaccion")]
    return " UNION ALL ".join(parts)


def _reconcile() -> str:
    cols = ("monto_total_ventas", "numero_de_transacciones", "monto_promedio_por_transaccion")
    net_src = f"(SELECT id_transaccion AS venta_id, tienda_id, monto FROM {V1})"
    j = (f"(SELECT COALESCE(l.tienda_id, r.tienda_id) AS tienda_id, l.tienda_id IS NULL AS no_l, "
         f"r.tienda_id IS NULL AS no_r, "
         + ", ".join(f"CAST(l.{c} AS DOUBLE) AS {c}_l, CAST(r.{c} AS DOUBLE) AS {c}_r" for c in cols)
         + f" FROM ({gold(silver(V1))}) l FULL OUTER JOIN ({gold(net_src)}) r "
           "ON l.tienda_id IS NOT DISTINCT FROM r.tienda_id)")
    keyed = (f"SELECT tienda_id, CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS DOUBLE) AS left_value, "
             f"CAST(NULL AS DOUBLE) AS right_value, CAST(NULL AS VARCHAR) AS left_text, CAST(NULL AS VARCHAR) AS right_text, CASE WHEN no_l THEN 'missing_left' ELSE 'missing_right' END "
             f"AS status FROM {j} WHERE no_l OR no_r")
    cells = " UNION ALL ".join(
        f"SELECT tienda_id, '{c}' AS column_name, {c}_l AS left_value, {c}_r AS right_value FROM {j} "
        f"WHERE NOT no_l AND NOT no_r" for c in cols)
    close = ("COALESCE((left_value IS NULL AND right_value IS NULL) OR (isnan(left_value) AND isnan(right_value)) "
             "OR abs(left_value - right_value) <= 1e-5 + 1e-5 * abs(right_value), false)")
    return (f"{keyed} UNION ALL SELECT tienda_id, column_name, left_value, right_value, NULL, NULL, 'value_mismatch' "
            f"FROM ({cells}) WHERE NOT {close}")


def _reconcile_orders() -> str:
    pairs = {"o_orderstatus": "'P'", "o_orderpriority": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END"}
    cells = [f"SELECT o_orderkey, '{c}' AS column_name, CAST(NULL AS DOUBLE) AS left_value, CAST(NULL AS DOUBLE) AS right_value, "
             f"{c} AS left_text, {other} AS right_text, 'value_mismatch' AS status FROM orders WHERE {c} IS DISTINCT FROM {other}"
             for c, other in pairs.items()]
    cells.append("SELECT o_orderkey, 'o_custkey', CAST(o_custkey AS DOUBLE), CAST(o_custkey + 1 AS DOUBLE), NULL, NULL, "
                 "'value_mismatch' FROM orders WHERE o_custkey % 7 = 0")
    cells.append("SELECT CAST(NULL AS BIGINT), 'o_totalprice', NULL, NULL, 'present', 'absent', 'missing_column'")
    return " UNION ALL ".join(cells)


def _reconcile_few() -> str:
    blank = "CAST(NULL AS VARCHAR) AS left_text, CAST(NULL AS VARCHAR) AS right_text"
    return (f"SELECT o_orderkey, CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS DOUBLE) AS left_value, CAST(NULL AS DOUBLE) AS right_value, {blank}, "
            "'missing_right' AS status FROM orders WHERE o_orderkey % 500 = 3 "
            f"UNION ALL SELECT o_orderkey, 'o_totalprice', o_totalprice, o_totalprice + 1, NULL, NULL, 'value_mismatch' FROM orders "
            "WHERE o_orderkey % 1000 = 7 AND 1 > 1e-5 + 1e-5 * (o_totalprice + 1)")


def _decode_quarantine() -> str:
    e = ("(SELECT event_id, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
         "user_id % 100 + 1 AS store, "
         "CASE WHEN event_type = 'error' THEN -value ELSE value END AS amount FROM events)")
    bad_json = (f"CAST(to_json({{'id': event_id, 'tienda_id': store, 'monto': CAST(amount AS VARCHAR), "
                f"'fecha': strftime(ts, {TS_TEXT})}}) AS VARCHAR)")
    return ("SELECT CASE k WHEN 0 THEN 'not json' WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN '[]' "
            f"ELSE {bad_json} END AS raw, "
            "CASE WHEN k IN (1, 2) THEN 'empty_message' ELSE 'malformed' END AS reason, "
            "CASE WHEN k = 4 THEN CAST(event_id AS VARCHAR) END AS id_transaccion, "
            "CASE WHEN k = 4 THEN CAST(store AS VARCHAR) END AS tienda_id, "
            "CAST(NULL AS DOUBLE) AS monto, CASE WHEN k = 4 THEN ts END AS fecha "
            f"FROM {e} WHERE k BETWEEN 0 AND 4")


def _stream_quarantine() -> str:
    e = ("(SELECT event_id, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
         "user_id % 100 + 1 AS store, "
         "CASE WHEN event_type = 'error' THEN -value ELSE value END AS amount FROM events)")
    good_json = (f"CAST(to_json({{'id': event_id, 'tienda_id': store, 'monto': amount, "
                 f"'fecha': strftime(ts, {TS_TEXT})}}) AS VARCHAR)")
    return ("SELECT CAST(event_id AS VARCHAR) AS id_transaccion, CAST(store AS VARCHAR) AS tienda_id, amount AS monto, "
            f"ts AS fecha, {good_json} AS raw, CAST(NULL AS VARCHAR) AS reason, 'good' AS route "
            f"FROM {e} WHERE k IS NULL OR k NOT BETWEEN 0 AND 4 "
            "UNION ALL SELECT id_transaccion, tienda_id, monto, fecha, raw, reason, 'quarantine' "
            f"FROM ({_decode_quarantine()})")


# Orders typed from the damaged text: NULL amount for pending orders, NULL date for urgent finished ones.
V3_DAMAGED_TYPED = ("(SELECT o_orderkey AS id_transaccion, CAST(o_custkey % 100 + 1 AS INTEGER) AS tienda_id, "
                    "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS monto, "
                    "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN NULL ELSE o_orderdate END "
                    "AS fecha FROM orders)")


def _bronze_rejects() -> str:
    bad_amount = "o_orderstatus = 'P'"
    bad_date = "(o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')"
    return ("SELECT CAST(o_orderkey AS VARCHAR) AS id_transaccion, "
            "CAST(o_custkey % 100 + 1 AS VARCHAR) AS tienda_id, "
            f"CASE WHEN {bad_amount} THEN 'pending' ELSE CAST(o_totalprice AS VARCHAR) END AS monto, "
            f"CASE WHEN {bad_date} THEN 'sin fecha' ELSE CAST(o_orderdate AS VARCHAR) END AS fecha, "
            f"concat_ws(',', CASE WHEN {bad_amount} THEN 'monto' END, CASE WHEN {bad_date} THEN 'fecha' END) "
            f"AS failed_columns FROM orders WHERE {bad_amount} OR {bad_date}")


def _csv_schema_check() -> str:
    ident = "o_orderkey + CASE WHEN o_orderpriority = '1-URGENT' THEN 3000000000 ELSE 0 END"

    def row(name: str, declared: str, misfit: str, wider: str) -> str:
        return (f"SELECT '{name}' AS column_name, '{declared}' AS declared, CASE WHEN COUNT(*) FILTER (WHERE {misfit}) > 0 THEN 'misfit' "
                f"ELSE 'ok' END AS status, COUNT(*) AS filled, COUNT(*) FILTER (WHERE {misfit}) AS misfits, "
                f"CASE WHEN COUNT(*) FILTER (WHERE {misfit}) > 0 THEN '{wider}' ELSE '{declared}' END AS fits FROM orders")

    return " UNION ALL ".join([
        row("id_transaccion", "int", f"{ident} > 2147483647", "bigint"),
        row("tienda_id", "int", "o_orderstatus = 'P'", "double"),
        row("monto", "double", "o_orderstatus = 'P'", "string"),
        "SELECT 'fecha', 'timestamp_ntz', 'missing', 0, 0, 'timestamp_ntz'",
        "SELECT 'prioridad', NULL, 'extra', COUNT(o_orderpriority), 0, 'string' FROM orders",
        "SELECT 'cliente', NULL, 'extra', COUNT(o_custkey), 0, 'int' FROM orders",
    ])


def _csv_schema_widened() -> str:
    return ("SELECT o_orderkey + CASE WHEN o_orderpriority = '1-URGENT' THEN 3000000000 ELSE 0 END AS id_transaccion, "
            "CAST(o_custkey % 100 + 1 AS DOUBLE) + CASE WHEN o_orderstatus = 'P' THEN 0.5 ELSE 0 END AS tienda_id, "
            "CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE CAST(o_totalprice AS VARCHAR) END AS monto, "
            "CAST(NULL AS TIMESTAMP) AS fecha, o_orderpriority AS prioridad, CAST(o_custkey AS INTEGER) AS cliente FROM orders")


# Orders as the folder of clashing files holds them: whole amounts in two of five files, text in one, no store in the last.
CLASHING = ("(SELECT o_orderkey AS id_transaccion, CASE WHEN o_orderkey % 5 < 4 THEN CAST(o_custkey % 100 + 1 AS INTEGER) END AS tienda_id, "
            "CASE WHEN o_orderkey % 5 < 2 THEN floor(o_totalprice) ELSE o_totalprice END AS monto, o_orderdate AS fecha, "
            "o_orderkey % 5 = 3 AND o_orderstatus = 'P' AS misfit FROM orders)")
CORRECTED = ("(SELECT o_orderkey AS id_transaccion, o_custkey % 100 + 1 AS tienda_id, o_orderdate AS fecha, "
             "CASE WHEN strftime(o_orderdate, '%Y-%m') IN ('1997-03', '1997-04', '1999-12') THEN o_totalprice + 1 ELSE o_totalprice END AS monto "
             "FROM orders)")


def _model_graph() -> str:
    # an amount goes to DECIMAL by its digits: a cast from DOUBLE may be off by one in the tenth decimal, which shows where few rows are summed
    total = money("CAST(monto AS VARCHAR)")
    months = f"(SELECT tienda_id, {total} AS monto_mes FROM {silver(V3)} GROUP BY tienda_id, anio_venta, mes_venta)"
    stores = f"(SELECT tienda_id, {total} AS monto_total_ventas, COUNT(venta_id) AS numero_de_transacciones FROM {silver(V3)} GROUP BY tienda_id)"
    return (f"SELECT s.tienda_id, s.monto_total_ventas, s.numero_de_transacciones, COUNT(*) AS meses, MAX(m.monto_mes) AS mejor_mes "
            f"FROM {stores} s JOIN {months} m ON s.tienda_id = m.tienda_id GROUP BY ALL")


def _model_graph_report() -> str:
    failures = f"(SELECT COUNT(*) FILTER (WHERE fecha_venta IS NULL) FROM {silver(V3_DAMAGED_TYPED)})"
    rows = {"staged_sales": "built", "silver_sales": "failed", "gold_store_sales": "skipped", "gold_store_months": "skipped",
            "report_stores": "skipped", "bronze_count": "built"}
    return " UNION ALL ".join(f"SELECT '{m}' AS model, '{s}' AS status, {failures if s == 'failed' else 'CAST(0 AS BIGINT)'} AS failures"
                              for m, s in rows.items())


def _publish_ordered() -> str:
    store, amount = "CAST(user_id % 100 + 1 AS VARCHAR)", "CASE WHEN event_type = 'error' THEN -value ELSE value END"
    return (f"SELECT {store} AS key, CAST(to_json({{'id': event_id, 'tienda_id': user_id % 100 + 1, 'monto': {amount}, "
            f"'fecha': strftime(ts, {TS_TEXT})}}) AS VARCHAR) AS value, row_number() OVER (PARTITION BY {store} ORDER BY ts, event_id) AS seq FROM events")


def oracle_sql() -> dict[str, str]:
    gold_v1 = gold(silver(V1))
    epoch = "CAST(floor(epoch_us(fecha) / 1000000) AS BIGINT)"
    return {
        "store_totals_min_amount": flagship(V2),
        "event_totals_min_amount": flagship(V1),
        "filter_min_amount": f"SELECT * FROM {V2} WHERE monto > 100",
        "store_totals_high_amount": flagship(V2, 30000),
        "filter_high_amount": f"SELECT * FROM {V2} WHERE monto > 30000",
        "store_sum": f"SELECT tienda_id, {money('monto')} AS monto_total FROM {V2} GROUP BY tienda_id",
        "store_sum_net": (f"SELECT l_suppkey AS tienda_id, {money('l_extendedprice * (1 - l_discount)')} AS monto_total "
                          "FROM lineitem GROUP BY l_suppkey"),
        "row_count": "SELECT COUNT(*) AS n_rows FROM lineitem",
        "store_sum_with_total": (f"SELECT tienda_id, CAST(GROUPING(tienda_id) AS INTEGER) AS is_total, "
                                 f"{money('monto')} AS monto_total, COUNT(*) AS n_rows "
                                 f"FROM {V2} GROUP BY ROLLUP (tienda_id)"),
        "preview_stores": f"{flagship(V1)} LIMIT 5",
        "csv_roundtrip": V3_BRONZE,
        "csv_scan_inferred": ("SELECT CAST(o_orderkey AS INTEGER) AS id_transaccion, "
                              "CAST(o_custkey % 100 + 1 AS INTEGER) AS tienda_id, "
                              "o_totalprice AS monto, o_orderdate AS fecha FROM orders"),
        "bronze_typed": V3_BRONZE,
        "bronze_product_sales": ("SELECT l_orderkey * 10 + l_linenumber AS id_transaccion, "
                                 "CAST(l_suppkey AS INTEGER) AS tienda_id, l_extendedprice AS monto, "
                                 "l_shipdate AS fecha, CAST(l_partkey AS VARCHAR) AS producto_id FROM lineitem"),
        "bronze_rejects": _bronze_rejects(),
        "bronze_landing_rows": f"SELECT id_transaccion, CAST(tienda_id AS INTEGER) AS tienda_id, monto, fecha FROM {V3_DAMAGED_TYPED}",
        "bronze_landing_rejects": _bronze_rejects(),
        "csv_schema_check": _csv_schema_check(),
        "csv_schema_widened": _csv_schema_widened(),
        "silver_zoned": ("SELECT event_id AS venta_id, epoch_us(ts) + 5 * 3600000000 AS instante_us, CAST(day(ts) AS INTEGER) AS dia_venta "
                         "FROM events WHERE event_type <> 'error' AND value > 0 OR event_type = 'error' AND value < 0"),
        "parquet_path_sql": V3_BRONZE,
        "named_source_scan": V3_BRONZE,
        "silver_sales": f"SELECT * FROM {silver(V1)}",
        "gold_store_sales": gold_v1,
        "silver_sql_model": f"SELECT * FROM {silver(V1)}",
        "gold_sql_model": gold_v1,
        "materialize_layer": gold_v1,
        "mixed_parquet_good": f"SELECT id_transaccion, tienda_id, monto, fecha FROM {CLASHING} WHERE NOT misfit",
        "mixed_parquet_rejects": ("SELECT 'monto' AS failed_columns, CAST(to_json({'id_transaccion': id_transaccion, 'tienda_id': tienda_id, "
                                  f"'monto': 'pending', 'fecha': strftime(fecha, {TS_TEXT})}}) AS VARCHAR) AS raw FROM {CLASHING} WHERE misfit"),
        "silver_month_rebuild": f"SELECT * FROM {silver(CORRECTED)}",
        "model_graph": _model_graph(),
        "model_graph_report": _model_graph_report(),
        "round_amount": ("SELECT l_orderkey * 10 + l_linenumber AS id_transaccion, "
                         "l_extendedprice * (1 - l_discount) AS monto_bruto, "
                         "CAST(ROUND(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(38,6)), 2) AS DOUBLE) "
                         "AS monto FROM lineitem"),
        "epoch_to_timestamp": (f"SELECT id_transaccion, {epoch} AS epoch_s, "
                               f"make_timestamp({epoch} * 1000000) AS fecha_s FROM {V1}"),
        "dq_report": _dq_report(),
        "dq_report_damaged": _dq_report(V3_DAMAGED_TYPED),
        "dq_duplicate_keys": (f"SELECT venta_id, COUNT(*) AS n_records FROM {silver(V2)} "
                              "WHERE venta_id IS NOT NULL GROUP BY venta_id HAVING COUNT(*) > 1"),
        "medallion_gated": gold_v1,
        "reconcile_totals": _reconcile(),
        "reconcile_orders": _reconcile_orders(),
        "reconcile_few": _reconcile_few(),
        "duplicate_keys_bucketed": (f"SELECT venta_id, COUNT(*) AS n_records FROM {silver(V2)} "
                                    "WHERE venta_id IS NOT NULL GROUP BY venta_id HAVING COUNT(*) > 1"),
        "first_n_to_publish": f"SELECT * FROM {V3} ORDER BY id_transaccion LIMIT 100",
        "publish_encode": ("SELECT CAST(user_id % 100 + 1 AS VARCHAR) AS key, "
                           "CAST(to_json({'id': event_id, 'tienda_id': user_id % 100 + 1, "
                           "'monto': CASE WHEN event_type = 'error' THEN -value ELSE value END, "
                           f"'fecha': strftime(ts, {TS_TEXT})}}) AS VARCHAR) AS value FROM events"),
        "publish_ordered": _publish_ordered(),
        "decode_sales_json": ("SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id_transaccion, "
                              "CAST(l_suppkey AS VARCHAR) AS tienda_id, CAST(l_partkey AS VARCHAR) AS producto_id, "
                              "l_extendedprice AS monto, l_shipdate AS fecha FROM lineitem"),
        "decode_quarantine": _decode_quarantine(),
        "json_inferred_columns": ("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k "
                                  "FROM events"),
        "json_bad_text": ("SELECT CAST(user_id % 100 + 1 AS VARCHAR) AS key, q.raw, 'malformed' AS reason FROM "
                          "(SELECT user_id, CASE CAST(json_extract_string(props, '$.k') AS INTEGER) WHEN 0 THEN 'not json' "
                          "WHEN 3 THEN '[]' WHEN 4 THEN CAST(to_json({'id': event_id, 'tienda_id': user_id % 100 + 1, "
                          "'monto': CAST(CASE WHEN event_type = 'error' THEN -value ELSE value END AS VARCHAR), "
                          f"'fecha': strftime(ts, {TS_TEXT})}}) AS VARCHAR) END AS raw FROM events) q WHERE q.raw IS NOT NULL"),
        "stream_decode_append": decoded_events(),
        "stream_parquet_batches": decoded_events(),
        "stream_quarantine": _stream_quarantine(),
        "stream_resume": decoded_events(),
        "stream_compacted": decoded_events(),
        "stream_schema_drift": decoded_events(),
        "stream_progress": ("SELECT CAST(4 AS BIGINT) AS n_batches, COUNT(*) AS n_input, COUNT(*) AS n_landed, "
                            "COUNT(*) FILTER (WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) BETWEEN 0 AND 4) AS n_quarantined FROM events"),
        "stream_to_gold": gold(silver(V1), "CAST(tienda_id AS INTEGER)"),
        "stream_gold_incremental": gold(silver(V1), "CAST(tienda_id AS INTEGER)"),
    }
