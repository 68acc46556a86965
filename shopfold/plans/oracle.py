"""DuckDB oracle SQL for the registered queries.

Each statement computes, straight from the driver tables, what the Spark
query must return after landing, unwrapping and flattening.  The shared CTEs
restate the landing recipe (see :mod:`shopfold.sources.landing`) and the
flattening rules on plain columns.
"""

from __future__ import annotations

from shopfold.operators.detect import ITEM_ROOTS, MIN_SIMILARITY
from shopfold.plans import fixture as fx
from shopfold.plans.q_detect import MAPPINGS
from shopfold.schema import DEFAULT_STATUS_MAPPINGS
from shopfold.sources.sites import SITE_STATUS_OVERRIDES

N_SITES = 6
PLATFORM_OF_SITE = {n: ["woocommerce", "gomag", "merchantpro"][n % 3] for n in range(N_SITES)}


def ts(d) -> str:
    return f"TIMESTAMP '{d.strftime('%Y-%m-%d %H:%M:%S')}'"


AS_OF = ts(fx.AS_OF)


def r2(x: str) -> str:
    """js_round2 on both sides: floor(x*100+0.5)/100."""
    return f"(floor(({x}) * 100 + 0.5) / 100)"


def status_map_values() -> str:
    rows = []
    for n in range(N_SITES):
        site = f"store_{n}"
        lst = SITE_STATUS_OVERRIDES.get(site) or DEFAULT_STATUS_MAPPINGS[PLATFORM_OF_SITE[n]]
        for i, (s, t) in enumerate(lst):
            rows.append(f"('{site}', {i}, '{s}', '{t}')")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") t(site_id, pos, source_status, target_status)"


def base_ctes(synced_at: str = AS_OF) -> str:
    """CTEs: o (orders + recipe), kept (kept items), flat (flattened rows)."""
    return f"""
li AS MATERIALIZED (
  SELECT l.l_orderkey AS ok, l.l_partkey, l.l_quantity, l.l_extendedprice, l.l_returnflag,
         l.l_linenumber, coalesce(p.p_brand, '') AS p_brand, coalesce(p.p_name, '') AS p_name,
         p.p_retailprice,
         row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey,
             l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax,
             l.l_returnflag, l.l_linestatus, l.l_shipdate) AS pos0
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
o AS MATERIALIZED (
  SELECT o_orderkey AS ok, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         CASE o_orderkey % 3 WHEN 0 THEN 'woocommerce' WHEN 1 THEN 'gomag' ELSE 'merchantpro' END
           AS platform,
         'store_' || CAST(o_orderkey % 6 AS VARCHAR) AS source_site,
         CASE WHEN o_custkey % 7 = 0 THEN 'RON' WHEN o_custkey % 5 = 0 THEN 'EUR' ELSE 'RON' END
           AS currency,
         CASE o_orderkey % 3
           WHEN 0 THEN CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'cancelled'
                       ELSE 'mystery' END
           WHEN 1 THEN CASE o_orderstatus WHEN 'F' THEN 'FINALIZATA' WHEN 'O' THEN 'Anulata'
                       ELSE 'mystery' END
           ELSE CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'cancelled'
                       ELSE 'mystery' END
         END AS raw_status,
         CASE WHEN o_orderkey = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
         {r2('o_totalprice')} AS order_total
  FROM orders
),
kept AS MATERIALIZED (
  SELECT li.*, o.platform,
         row_number() OVER (PARTITION BY li.ok ORDER BY li.pos0) - 1 AS item_pos
  FROM li JOIN o ON li.ok = o.ok
  WHERE NOT (o.platform = 'gomag' AND li.l_returnflag = 'N')
),
flat AS MATERIALIZED (
  SELECT o.order_id, o.o_orderdate AS order_date, o.raw_status AS order_status, o.order_total,
         o.currency,
         CASE WHEN k.l_partkey = 0 THEN '' ELSE CAST(k.l_partkey AS VARCHAR) END AS product_id,
         k.p_brand AS product_sku, k.p_name AS product_name,
         {r2('k.p_retailprice')} AS product_price,
         CAST(k.l_quantity AS BIGINT) AS product_quantity,
         {r2('''CASE o.platform WHEN 'woocommerce' THEN k.l_extendedprice
                WHEN 'gomag' THEN k.p_retailprice * k.l_quantity
                ELSE CASE WHEN k.l_linenumber % 2 = 1 AND k.l_extendedprice <> 0
                          THEN k.l_extendedprice ELSE k.p_retailprice * k.l_quantity END END''')}
           AS product_total,
         o.source_site, {synced_at} AS synced_at, k.item_pos, o.platform, false AS is_placeholder
  FROM o JOIN kept k ON k.ok = o.ok
  UNION ALL
  SELECT o.order_id, o.o_orderdate, o.raw_status, o.order_total, o.currency,
         '', '', '', 0.0, CAST(0 AS BIGINT), 0.0, o.source_site, {synced_at}, 0, o.platform, true
  FROM o WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.ok = o.ok)
),
smap AS ({status_map_values()}),
lk AS (
  SELECT site_id, lower(source_status) AS k, arg_min(target_status, pos) AS target_status
  FROM smap GROUP BY ALL
),
norm AS MATERIALIZED (
  SELECT f.* REPLACE (coalesce(lk.target_status, '[UNMAPPED] ' || f.order_status)
                      AS order_status)
  FROM flat f LEFT JOIN lk ON lk.site_id = f.source_site AND lk.k = lower(f.order_status)
)"""


FACT = ("order_id, order_date, order_status, order_total, currency, product_id, product_sku, "
        "product_name, product_price, product_quantity, product_total, source_site, synced_at")


def with_base(body: str, synced_at: str = AS_OF) -> str:
    return "WITH " + base_ctes(synced_at) + ",\n" + body


DEDUP = """dedup AS (
  SELECT * FROM norm
  QUALIFY row_number() OVER (PARTITION BY order_id, product_id, product_sku, source_site
                             ORDER BY synced_at DESC, item_pos DESC) = 1
)"""

MERGE_INPUTS = f"""tgt AS MATERIALIZED (
  SELECT order_id, order_date, '{fx.TARGET_STATUS}' AS order_status, order_total, currency,
         product_id, product_sku, product_name, product_price, product_quantity, product_total,
         source_site, {ts(fx.TARGET_SYNCED_AT)} AS synced_at
  FROM flat WHERE order_date < {ts(fx.TARGET_END)}
),
src AS MATERIALIZED (
  SELECT * FROM norm WHERE order_date >= {ts(fx.SOURCE_START)}
  QUALIFY row_number() OVER (PARTITION BY order_id, product_id, product_sku, source_site
                             ORDER BY synced_at DESC, item_pos DESC) = 1
)"""


def sql_catalog() -> dict[str, str]:
    q = sql_catalog_core()
    q.update(more_sql())
    q.update(detect_sql())
    q.update(function_sql())
    q.update(table_sql())
    return q


def sql_catalog_core() -> dict[str, str]:
    q: dict[str, str] = {}
    for p in ("woocommerce", "gomag", "merchantpro"):
        q[f"flatten_{p}"] = with_base(
            f"x AS (SELECT 1) SELECT {FACT} FROM flat WHERE platform = '{p}'")
    q["placeholder_row"] = with_base(f"x AS (SELECT 1) SELECT {FACT} FROM flat WHERE is_placeholder")
    q["normalize_status"] = with_base(f"x AS (SELECT 1) SELECT {FACT} FROM norm")
    q["dedup_latest"] = with_base(DEDUP + f" SELECT {FACT} FROM dedup")
    q["merge_upsert"] = with_base(MERGE_INPUTS + f"""
SELECT t.order_id,
       CASE WHEN s.order_id IS NOT NULL THEN s.order_date ELSE t.order_date END AS order_date,
       CASE WHEN s.order_id IS NOT NULL THEN s.order_status ELSE t.order_status END AS order_status,
       CASE WHEN s.order_id IS NOT NULL THEN s.order_total ELSE t.order_total END AS order_total,
       CASE WHEN s.order_id IS NOT NULL THEN s.currency ELSE t.currency END AS currency,
       t.product_id,
       CASE WHEN s.order_id IS NOT NULL THEN s.product_sku ELSE t.product_sku END AS product_sku,
       CASE WHEN s.order_id IS NOT NULL THEN s.product_name ELSE t.product_name END AS product_name,
       CASE WHEN s.order_id IS NOT NULL THEN s.product_price ELSE t.product_price END AS product_price,
       CASE WHEN s.order_id IS NOT NULL THEN s.product_quantity ELSE t.product_quantity END
         AS product_quantity,
       CASE WHEN s.order_id IS NOT NULL THEN s.product_total ELSE t.product_total END AS product_total,
       t.source_site,
       CASE WHEN s.order_id IS NOT NULL THEN s.synced_at ELSE t.synced_at END AS synced_at
FROM tgt t LEFT JOIN src s ON t.order_id = s.order_id AND t.product_id = s.product_id
     AND t.product_sku = s.product_sku AND t.source_site = s.source_site
UNION ALL
SELECT {FACT} FROM src s WHERE NOT EXISTS (
  SELECT 1 FROM tgt t WHERE t.order_id = s.order_id AND t.product_id = s.product_id
     AND t.product_sku = s.product_sku AND t.source_site = s.source_site)""")
    q["merge_status_only"] = with_base(MERGE_INPUTS + """
SELECT t.order_id, t.order_date,
       CASE WHEN s.order_id IS NOT NULL THEN s.order_status ELSE t.order_status END AS order_status,
       t.order_total, t.currency, t.product_id, t.product_sku, t.product_name, t.product_price,
       t.product_quantity, t.product_total, t.source_site,
       CASE WHEN s.order_id IS NOT NULL THEN s.synced_at ELSE t.synced_at END AS synced_at
FROM tgt t LEFT JOIN src s ON t.order_id = s.order_id AND t.product_id = s.product_id
     AND t.product_sku = s.product_sku AND t.source_site = s.source_site""")
    return q


# ---------------------------------------------------------------------------
# Sites, windows, runs
# ---------------------------------------------------------------------------

def _site_rule_rows() -> str:
    from shopfold.schema import LOOKBACK_OPTIONS
    from shopfold.sources.sites import DISABLED_SITES, SITES_WITHOUT_FEED
    rows = []
    for n in range(N_SITES):
        sid = f"store_{n}"
        p = PLATFORM_OF_SITE[n]
        name = f"Store {n} {p.capitalize()}"
        lb = LOOKBACK_OPTIONS[n % len(LOOKBACK_OPTIONS)]
        rows.append(f"('{sid}', '{p}', '{name}', {lb}, {str(n % 2 == 0).lower()}, "
                    f"{str(sid not in DISABLED_SITES).lower()}, "
                    f"{str(sid not in SITES_WITHOUT_FEED).lower()})")
    return ("SELECT * FROM (VALUES " + ", ".join(rows) +
            ") t(site_id, platform, name, lookback_days, hourly, enabled, has_feed)")


def sites_cte() -> str:
    # Only sites that occur in the data exist.
    return f"""sites AS (
  SELECT r.* FROM ({_site_rule_rows()}) r
  WHERE r.site_id IN (SELECT DISTINCT 'store_' || CAST(o_orderkey % 6 AS VARCHAR) FROM orders)
)"""


def window_cte(mode: str = "full", site_filter: str = "true") -> str:
    if mode == "hourly":
        since = f"date_trunc('day', {AS_OF})"
    else:
        since = f"({AS_OF} - to_days(CAST(s.lookback_days AS INTEGER)))"
    return f"""win AS MATERIALIZED (
  SELECT n.* FROM norm n JOIN sites s ON s.site_id = n.source_site
  WHERE ({site_filter})
    AND CASE WHEN n.platform = 'gomag' THEN n.order_date >= {since}
             ELSE n.order_date > {since} END
)"""


def run_target_cte() -> str:
    return f"""tgt AS MATERIALIZED (
  SELECT order_id, order_date, '{fx.TARGET_STATUS}' AS order_status, order_total, currency,
         product_id, product_sku, product_name, product_price, product_quantity, product_total,
         source_site, {ts(fx.TARGET_SYNCED_AT)} AS synced_at
  FROM flat WHERE order_date >= {ts(fx.RUN_TARGET_START)} AND order_date < {ts(fx.RUN_TARGET_END)}
)"""


MERGE_BODY = f"""
SELECT t.order_id,
       CASE WHEN s.order_id IS NOT NULL THEN s.order_date ELSE t.order_date END AS order_date,
       CASE WHEN s.order_id IS NOT NULL THEN s.order_status ELSE t.order_status END AS order_status,
       CASE WHEN s.order_id IS NOT NULL THEN s.order_total ELSE t.order_total END AS order_total,
       CASE WHEN s.order_id IS NOT NULL THEN s.currency ELSE t.currency END AS currency,
       t.product_id,
       CASE WHEN s.order_id IS NOT NULL THEN s.product_sku ELSE t.product_sku END AS product_sku,
       CASE WHEN s.order_id IS NOT NULL THEN s.product_name ELSE t.product_name END AS product_name,
       CASE WHEN s.order_id IS NOT NULL THEN s.product_price ELSE t.product_price END AS product_price,
       CASE WHEN s.order_id IS NOT NULL THEN s.product_quantity ELSE t.product_quantity END
         AS product_quantity,
       CASE WHEN s.order_id IS NOT NULL THEN s.product_total ELSE t.product_total END AS product_total,
       t.source_site,
       CASE WHEN s.order_id IS NOT NULL THEN s.synced_at ELSE t.synced_at END AS synced_at
FROM tgt t LEFT JOIN src s ON t.order_id = s.order_id AND t.product_id = s.product_id
     AND t.product_sku = s.product_sku AND t.source_site = s.source_site
UNION ALL
SELECT {FACT} FROM src s WHERE NOT EXISTS (
  SELECT 1 FROM tgt t WHERE t.order_id = s.order_id AND t.product_id = s.product_id
     AND t.product_sku = s.product_sku AND t.source_site = s.source_site)"""

STATUS_MERGE_BODY = """
SELECT t.order_id, t.order_date,
       CASE WHEN s.order_id IS NOT NULL THEN s.order_status ELSE t.order_status END AS order_status,
       t.order_total, t.currency, t.product_id, t.product_sku, t.product_name, t.product_price,
       t.product_quantity, t.product_total, t.source_site,
       CASE WHEN s.order_id IS NOT NULL THEN s.synced_at ELSE t.synced_at END AS synced_at
FROM tgt t LEFT JOIN src s ON t.order_id = s.order_id AND t.product_id = s.product_id
     AND t.product_sku = s.product_sku AND t.source_site = s.source_site"""

SRC_FROM_WIN = """src AS MATERIALIZED (
  SELECT * FROM win
  QUALIFY row_number() OVER (PARTITION BY order_id, product_id, product_sku, source_site
                             ORDER BY synced_at DESC, item_pos DESC) = 1
)"""


def run_sql(mode: str, site_filter: str, status_only: bool = False) -> str:
    body = STATUS_MERGE_BODY if status_only else MERGE_BODY
    covered = f"tgt_all AS (SELECT 1)"
    return with_base(",\n".join([
        sites_cte(), window_cte(mode, site_filter),
        run_target_cte().replace("FROM flat WHERE", "FROM flat f JOIN sites s ON s.site_id = "
                                 f"f.source_site WHERE ({site_filter}) AND"),
        SRC_FROM_WIN, covered]) + body)


FULL_SITES = "s.enabled"
HOURLY_SITES = "s.enabled AND s.hourly"


def run_counts_cte() -> str:
    return f"""cnt AS (
  SELECT s.site_id, s.platform, s.name, s.enabled, s.hourly, s.lookback_days,
         (SELECT count(*) FROM win w WHERE w.source_site = s.site_id) AS row_count
  FROM sites s
),
res AS (
  SELECT site_id, {AS_OF} AS started_at, {AS_OF} AS completed_at,
         CAST(0 AS BIGINT) AS duration_seconds, 'success' AS status,
         CAST(row_count AS BIGINT) AS row_count, 'full' AS sync_type,
         CAST(NULL AS VARCHAR) AS error
  FROM cnt WHERE enabled
),
marked AS (
  SELECT s.site_id, s.name, s.platform, s.enabled,
         r.started_at AS last_sync_at, r.status AS last_sync_status,
         r.row_count AS last_sync_row_count
  FROM sites s LEFT JOIN res r ON r.site_id = s.site_id
)"""


def history_cte() -> str:
    return """hist AS (
  SELECT 'store_' || CAST(o_orderkey % 6 AS VARCHAR) AS site_id, o_orderdate AS day,
         count(*) AS n
  FROM orders GROUP BY ALL
),
history AS (
  SELECT site_id, day + INTERVAL 6 HOUR AS started_at,
         day + INTERVAL 6 HOUR + to_seconds(CAST(n AS BIGINT)) AS completed_at,
         CAST(n AS BIGINT) AS duration_seconds,
         CASE WHEN n % 4 = 0 THEN 'error' ELSE 'success' END AS status,
         CAST(CASE WHEN n % 4 = 0 THEN 0 ELSE n END AS BIGINT) AS row_count,
         CASE dayofmonth(day) % 3 WHEN 0 THEN 'full' WHEN 1 THEN 'hourly' ELSE 'status_only' END
           AS sync_type,
         CASE WHEN n % 4 = 0 THEN 'HTTP 500' END AS error
  FROM hist
)"""


def _top_n(src: str, n: int, where: str = "true") -> str:
    return (f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY site_id ORDER BY "
            f"started_at DESC, completed_at DESC) AS INTEGER) AS rn FROM {src} WHERE {where}) "
            f"WHERE rn <= {n}")


def more_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    from shopfold.schema import PAGE_SIZE
    q["read_raw_orders"] = with_base("""cnt_l AS (SELECT ok, count(*) AS c FROM li GROUP BY ok)
SELECT o.source_site, o.platform, o.order_id, CAST(coalesce(c.c, 0) AS BIGINT) AS n_items
FROM o LEFT JOIN cnt_l c ON c.ok = o.ok""")
    q["unwrap_envelope"] = with_base(f"""pg AS (
  SELECT source_site, platform, strftime(o_orderdate, '%Y-%m') AS m,
         (ok // 6) // CASE WHEN platform = 'gomag' THEN {PAGE_SIZE['gomag']}
                           ELSE {PAGE_SIZE['woocommerce']} END AS page_no
  FROM o)
SELECT source_site, platform, count(DISTINCT (m, page_no)) AS n_pages,
       CAST(count(*) AS BIGINT) AS n_orders
FROM pg GROUP BY ALL""")
    q["total_available"] = with_base("""x AS (SELECT 1)
SELECT source_site, platform, CAST(count(*) AS BIGINT) AS total_available FROM o GROUP BY ALL""")
    q["sample_orders"] = with_base("""x AS (SELECT 1)
SELECT source_site, order_id, o_orderdate AS order_date, CAST(rn AS INTEGER) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY source_site ORDER BY o_orderdate DESC, order_id ASC)
    AS rn FROM o) WHERE rn <= 5""")
    q["newest_orders"] = with_base("""x AS (SELECT 1)
SELECT source_site, order_id, o_orderdate AS order_date FROM o""")
    q["limit_n"] = with_base("""x AS (SELECT 1)
SELECT source_site, order_id, o_orderdate AS order_date FROM o
ORDER BY o_orderdate DESC, order_id ASC LIMIT 10""")
    q["since_filter"] = with_base(sites_cte() + ",\n" + window_cte() + f" SELECT {FACT} FROM win")
    q["gomag_take_while"] = with_base(sites_cte() + ",\n" + window_cte() +
                                      f" SELECT {FACT} FROM win WHERE platform = 'gomag'")
    q["lookback_window"] = with_base(sites_cte() + f""",
sw AS (SELECT site_id, lookback_days, {AS_OF} - to_days(CAST(lookback_days AS INTEGER)) AS since
       FROM sites)
SELECT sw.site_id, CAST(sw.lookback_days AS INTEGER) AS lookback_days, sw.since,
       CAST(count_if(CASE WHEN o.platform = 'gomag' THEN o.o_orderdate >= sw.since
                     ELSE o.o_orderdate > sw.since END) AS BIGINT) AS orders_in_window
FROM sw JOIN o ON o.source_site = sw.site_id GROUP BY ALL""")
    q["today_window"] = with_base(sites_cte() + ",\n" + window_cte("hourly", HOURLY_SITES) +
                                  f" SELECT {FACT} FROM win")
    q["enabled_sites"] = with_base(sites_cte() + " SELECT site_id, platform FROM sites WHERE enabled")
    q["read_sites"] = with_base(sites_cte() + """
SELECT s.site_id, s.name, s.platform, 'orders_' || s.site_id AS table_name,
       CAST(s.lookback_days AS INTEGER) AS lookback_days, s.hourly AS hourly_sync_enabled,
       s.enabled, s.has_feed, CAST(m.pos AS INTEGER) AS pos, m.source_status, m.target_status
FROM sites s JOIN smap m ON m.site_id = s.site_id""")
    n_columns = " ".join(f"WHEN '{p}' THEN {len(m)}" for p, m in MAPPINGS.items())
    q["read_sites_json"] = with_base(sites_cte() + f"""
SELECT s.site_id, s.name, s.platform, 'orders_' || s.site_id AS table_name,
       CAST(s.lookback_days AS INTEGER) AS lookback_days, s.hourly AS hourly_sync_enabled,
       s.enabled, s.has_feed, CAST(CASE s.platform {n_columns} ELSE 0 END AS BIGINT) AS n_columns,
       CAST(m.pos AS INTEGER) AS pos, m.source_status, m.target_status
FROM sites s JOIN smap m ON m.site_id = s.site_id""")
    q["hourly_sites"] = with_base(sites_cte() +
                                  " SELECT site_id, platform FROM sites WHERE enabled AND hourly")
    q["drop_service_items"] = with_base("""x AS (SELECT 1)
SELECT o.source_site, o.order_id,
       CAST(count(li.ok) FILTER (WHERE li.l_returnflag <> 'N') AS BIGINT) AS kept_items,
       CAST(count(li.ok) FILTER (WHERE li.l_returnflag = 'N') AS BIGINT) AS dropped_items
FROM o LEFT JOIN li ON li.ok = o.ok WHERE o.platform = 'gomag' GROUP BY o.ok, o.source_site, o.order_id""")
    q["run_row_count"] = with_base(sites_cte() + ",\n" + window_cte() + """
SELECT source_site, count(*) AS row_count, CAST(0 AS BIGINT) AS reject_count FROM win GROUP BY ALL""")
    statuses = """st AS (
  SELECT DISTINCT source_site, platform, raw_status FROM o WHERE raw_status <> ''
)"""
    q["distinct_statuses"] = with_base(statuses + " SELECT source_site, raw_status FROM st")
    dflt = []
    for p, lst in DEFAULT_STATUS_MAPPINGS.items():
        for i, (s, t) in enumerate(lst):
            dflt.append(f"('{p}', {i}, '{s}', '{t}')")
    q["detect_status_map"] = with_base(statuses + f""",
d AS (SELECT * FROM (VALUES {', '.join(dflt)}) t(platform, pos, source_status, target_status)),
dl AS (SELECT platform, lower(source_status) AS k, arg_min(source_status, pos) AS source_status,
              arg_min(target_status, pos) AS target_status FROM d GROUP BY ALL)
SELECT st.source_site, st.raw_status, coalesce(dl.source_status, st.raw_status) AS source_status,
       coalesce(dl.target_status, 'order_processed') AS target_status
FROM st LEFT JOIN dl ON dl.platform = st.platform AND dl.k = lower(st.raw_status)""")
    q["unmapped_statuses"] = with_base("""x AS (SELECT 1)
SELECT source_site, substring(order_status, 12) AS raw_status, count(*) AS row_count
FROM norm WHERE starts_with(order_status, '[UNMAPPED] ') GROUP BY ALL""")
    q["unmapped_label"] = with_base("""x AS (SELECT 1)
SELECT source_site, order_id, product_id, order_status FROM norm
WHERE starts_with(order_status, '[UNMAPPED] ')""")
    q["merge_match"] = with_base(MERGE_INPUTS + """
SELECT t.order_id, t.product_id, t.product_sku, t.source_site,
       EXISTS (SELECT 1 FROM src s WHERE t.order_id = s.order_id AND t.product_id = s.product_id
               AND t.product_sku = s.product_sku AND t.source_site = s.source_site) AS matched
FROM tgt t""")
    q["site_lookup"] = with_base(sites_cte() + """
SELECT f.source_site, f.order_id, f.product_id, s.name AS site_name, s.platform,
       'orders_' || s.site_id AS table_name, s.enabled
FROM flat f JOIN sites s ON s.site_id = f.source_site""")
    q["union_sites"] = with_base(f"x AS (SELECT 1) SELECT {FACT} FROM flat")
    q["distinct_ids"] = with_base("""x AS (SELECT 1)
SELECT DISTINCT source_site, product_id FROM flat WHERE product_id <> ''""")

    # --- runs -------------------------------------------------------------
    single = f"s.enabled AND s.site_id = '{fx.RUN_SITE}'"
    q["sync_full"] = run_sql("full", single)
    q["sync_hourly"] = run_sql("hourly", HOURLY_SITES)
    q["sync_status_only"] = run_sql("full", FULL_SITES, status_only=True)
    q["sync_all"] = run_sql("full", FULL_SITES)
    runs = ",\n".join([sites_cte(), window_cte("full", FULL_SITES), run_counts_cte()])
    end = f"{AS_OF} + to_seconds({int(fx.RUN_TIME.total_seconds())})"
    failed = f"site_id = '{fx.FAILING_SITE}'"
    q["run_result"] = with_base(runs + f"""
SELECT site_id, started_at, {end} AS completed_at, CAST({int(fx.RUN_TIME.total_seconds())} AS BIGINT) AS duration_seconds,
       CASE WHEN {failed} THEN 'error' ELSE 'success' END AS status,
       CASE WHEN {failed} THEN 0 ELSE row_count END AS row_count, sync_type,
       CASE WHEN {failed} THEN 'CAST_INVALID_INPUT' END AS error FROM res
UNION ALL
SELECT '{fx.NO_CONNECTOR_SITE}', {AS_OF}, {end}, {int(fx.RUN_TIME.total_seconds())}, 'error', 0, 'full',
       'No connector for platform'""")
    q["sync_status"] = with_base(runs + """
SELECT site_id, name, platform, coalesce(last_sync_status, 'idle') AS status, last_sync_at,
       CAST(coalesce(last_sync_row_count, 0) AS BIGINT) AS last_sync_row_count, enabled
FROM marked""")
    q["report_totals"] = with_base(runs + """
SELECT CAST(coalesce(sum(coalesce(last_sync_row_count, 0)), 0) AS BIGINT) AS total_rows,
       CAST(count_if(last_sync_status = 'success') AS BIGINT) AS success_count,
       CAST(count_if(last_sync_status = 'error') AS BIGINT) AS error_count, count(*) AS site_count
FROM marked""")
    local = f"strftime(timezone('Europe/Bucharest', last_sync_at AT TIME ZONE 'UTC'), '%d.%m.%Y, %H:%M:%S')"
    q["site_report"] = with_base(runs + f"""
SELECT name, platform,
       CASE last_sync_status WHEN 'success' THEN 'Success' WHEN 'error' THEN 'Error'
            WHEN 'running' THEN 'Running' ELSE 'Never synced' END AS label,
       CAST(coalesce(last_sync_row_count, 0) AS BIGINT) AS rows,
       CASE WHEN last_sync_at IS NULL THEN 'Never' ELSE {local} END AS last_sync
FROM marked""")
    q["dashboard_summary"] = with_base(runs + """
SELECT count(*) AS sites, CAST(count_if(enabled) AS BIGINT) AS active,
       CAST(count_if(last_sync_status = 'error') AS BIGINT) AS errors,
       max(last_sync_at) AS last_sync_at FROM marked""")
    q["read_history"] = with_base(history_cte() + " SELECT * FROM history")
    q["history_top_n"] = with_base(history_cte() + " " + _top_n("history", 5))
    q["history_top_n_site"] = with_base(history_cte() + " " + _top_n(
        "history", 20, f"site_id = '{fx.RUN_SITE}'"))
    q["history_retention"] = with_base(history_cte() + " SELECT * EXCLUDE (rn) FROM (" +
                                       _top_n("history", 100) + ")")
    q["append_history"] = with_base(history_cte() + ",\n" + runs + """,
allh AS (SELECT * FROM history UNION ALL SELECT * FROM res)
SELECT * EXCLUDE (rn) FROM (""" + _top_n("allh", 100) + ")")
    return q


# ---------------------------------------------------------------------------
# Feed, detection, mapping
# ---------------------------------------------------------------------------

def feed_ctes() -> str:
    return sites_cte() + """,
feedsites AS (SELECT site_id, CAST(regexp_extract(site_id, '([0-9]+)$', 1) AS BIGINT) AS n
              FROM sites WHERE has_feed),
feed AS (SELECT DISTINCT o.source_site, li.l_partkey AS pk
         FROM li JOIN o ON li.ok = o.ok JOIN feedsites f ON f.site_id = o.source_site
         WHERE (li.l_partkey + f.n) % 10 <> 0),
feedids AS (SELECT source_site, CAST(pk AS VARCHAR) AS product_id FROM feed),
rows3 AS (SELECT source_site, order_id, product_id FROM flat)"""


def detect_ctes() -> str:
    return """ol AS (SELECT o.source_site, o.platform, o.ok, o.o_custkey, count(li.ok) AS nl
       FROM o LEFT JOIN li ON li.ok = o.ok GROUP BY ALL),
top AS (
  SELECT DISTINCT source_site, unnest(CASE platform
      WHEN 'woocommerce' THEN ['id', 'status', 'date_created', 'total', 'line_items']
      WHEN 'gomag' THEN ['id', 'date', 'status', 'total', 'delivery.total', 'items']
      ELSE ['id', 'shipping_status', 'status', 'total_amount', 'line_items'] END) AS path
  FROM ol
  UNION SELECT DISTINCT source_site, 'currency' FROM ol WHERE o_custkey % 7 <> 0
  UNION SELECT DISTINCT source_site, 'date_created' FROM ol
        WHERE platform = 'merchantpro' AND ok % 4 <> 3
  UNION SELECT DISTINCT source_site, 'created_at' FROM ol
        WHERE platform = 'merchantpro' AND ok % 4 = 3
),
leaves AS (
  SELECT source_site, path FROM top WHERE path NOT IN ('line_items', 'items')
  UNION SELECT DISTINCT source_site, CASE platform WHEN 'gomag' THEN 'items' ELSE 'line_items' END
        FROM ol WHERE nl = 0 AND NOT (platform = 'gomag' AND ok % 2 = 0)
  UNION SELECT DISTINCT o.source_site, 'line_items.' || unnest(CASE o.platform
          WHEN 'woocommerce' THEN ['product_id', 'sku', 'name', 'price', 'quantity', 'total']
          ELSE ['product_id', 'product_sku', 'product_name', 'unit_price_gross', 'quantity',
                'line_subtotal_gross'] END)
        FROM o JOIN li ON li.ok = o.ok WHERE o.platform <> 'gomag'
  UNION SELECT DISTINCT o.source_site,
          CASE WHEN o.ok % 2 = 0 THEN 'items.' || CAST(li.pos0 AS VARCHAR) || '.' ELSE 'items.' END
          || unnest(['id', 'sku', 'name', 'price', 'type',
                     CASE WHEN li.l_linenumber % 2 = 1 THEN 'quantity' ELSE 'qty' END])
        FROM o JOIN li ON li.ok = o.ok WHERE o.platform = 'gomag'
)"""


def detect_sql() -> dict[str, str]:
    from shopfold.schema import STANDARD_COLUMNS
    from shopfold.plans.q_detect import MAPPINGS  # noqa: F401  (documentation of the mapping)
    q: dict[str, str] = {}
    q["read_feed"] = with_base(feed_ctes() + " SELECT source_site, product_id FROM feedids")
    q["read_feed_containers"] = q["read_feed"]
    q["nonblank_ids"] = with_base(feed_ctes() + """
SELECT source_site, CAST(count(*) + count_if(pk % 13 = 0 OR pk % 17 = 0) AS BIGINT) AS entries,
       count(*) AS kept_entries FROM feed GROUP BY ALL""")
    q["feed_count"] = with_base(feed_ctes() +
                                " SELECT source_site, count(*) AS product_count FROM feed GROUP BY ALL")
    q["feed_membership"] = with_base(feed_ctes() + """
SELECT r.source_site, r.order_id, r.product_id,
       CASE WHEN s.has_feed THEN EXISTS (SELECT 1 FROM feedids f WHERE f.source_site = r.source_site
                                         AND f.product_id = r.product_id) END AS in_feed
FROM rows3 r LEFT JOIN sites s ON s.site_id = r.source_site""")
    q["in_feed"] = with_base(feed_ctes() + """
SELECT r.source_site, r.order_id, r.product_id FROM rows3 r
WHERE EXISTS (SELECT 1 FROM feedids f WHERE f.source_site = r.source_site
              AND f.product_id = r.product_id)""")
    q["not_in_feed"] = with_base(feed_ctes() + """
SELECT r.source_site, r.order_id, r.product_id FROM rows3 r JOIN sites s ON s.site_id = r.source_site
WHERE s.has_feed AND NOT EXISTS (SELECT 1 FROM feedids f WHERE f.source_site = r.source_site
                                 AND f.product_id = r.product_id)""")
    q["detect_columns"] = with_base(detect_ctes() + " SELECT source_site, path FROM leaves")
    q["clean_sample"] = with_base(detect_ctes() + " SELECT source_site, path FROM top")
    std = ", ".join(f"'{c}'" for c in STANDARD_COLUMNS)
    q["auto_map"] = with_base(detect_ctes() + f"""
SELECT source_site, path AS source_column,
       CASE WHEN path IN ({std}) THEN path ELSE '' END AS target_column,
       CASE WHEN path IN ({std}) THEN 'confirmed' ELSE 'unmapped' END AS status
FROM leaves""")
    columns = ", ".join(f"({k}, '{c}')" for k, c in enumerate(STANDARD_COLUMNS))
    plain = r"trim(regexp_replace(lower(regexp_replace({}, '([a-z0-9])([A-Z])', '\1_\2', 'g')), '[^a-z0-9]+', '_', 'g'), '_')"
    like = "1.0 - levenshtein({0}, c.name) / CAST(greatest(length({0}), length(c.name)) AS DOUBLE)"
    roots = ", ".join(f"'{r}'" for r in ITEM_ROOTS)
    q["suggest_columns"] = with_base(detect_ctes() + f""",
named AS (
  SELECT source_site, path, {plain.format("path")} AS whole, {plain.format("string_split(path, '.')[-1]")} AS last,
         CASE WHEN path NOT LIKE '%.%' THEN 'order_'
              WHEN string_split(path, '.')[1] IN ({roots}) THEN 'product_' ELSE '' END AS prefix
  FROM leaves),
scored AS (
  SELECT n.*, c.k, c.name, round(greatest({like.format("n.whole")}, {like.format("n.last")},
         {like.format("n.prefix || n.last")}), 4) AS s
  FROM named n, (VALUES {columns}) c(k, name)),
best AS (SELECT source_site, path, max(s) AS s, arg_min(name, (-s, k)) AS name FROM scored GROUP BY ALL)
SELECT source_site, path AS source_column, CASE WHEN s >= {MIN_SIMILARITY} THEN name ELSE '' END AS target_column,
       CASE WHEN path = name THEN 'confirmed' ELSE 'unmapped' END AS status,
       CASE WHEN s >= {MIN_SIMILARITY} THEN s END AS similarity
FROM best""")
    pattern = lambda c, p, g: f"CASE WHEN regexp_matches({c}, '{p}') THEN regexp_extract({c}, '{p}', {g}) END"
    q["regex_transform"] = f"""
SELECT p_partkey, {pattern("p_brand", "#?([0-9]+)$", 1)} AS brand_number,
       {pattern("p_type", "[A-Z]+$", 0)} AS last_word, {pattern("p_name", "([a-z]+) ([a-z]+)", 1)} AS first_word
FROM part"""
    q["detect_columns_events"] = """
SELECT DISTINCT event_type AS source_site, unnest(json_keys(props)) AS path
FROM events WHERE props IS NOT NULL"""
    q["nested_value"] = with_base("""first_li AS (SELECT ok, l_partkey FROM li WHERE pos0 = 1)
SELECT o.source_site, o.order_id,
       CASE o.platform WHEN 'gomag' THEN 'items.id' ELSE 'line_items.product_id' END AS path,
       CASE WHEN f.ok IS NULL OR (o.platform = 'gomag' AND o.ok % 2 = 0) THEN '—'
            ELSE CAST(f.l_partkey AS VARCHAR) END AS sample
FROM o LEFT JOIN first_li f ON f.ok = o.ok""")
    q["preview_mapping"] = with_base(f"""top5 AS (
  SELECT ok FROM (SELECT ok, row_number() OVER (PARTITION BY source_site
                  ORDER BY o_orderdate DESC, order_id ASC) AS rn FROM o) WHERE rn <= 5)
SELECT {FACT} FROM flat f WHERE EXISTS (
  SELECT 1 FROM top5 t JOIN o ON o.ok = t.ok WHERE o.order_id = f.order_id
  AND o.source_site = f.source_site)""")
    q["apply_mapping"] = with_base("""x AS (SELECT 1)
SELECT o.source_site, CAST(o.ok AS VARCHAR) AS order_id, o.o_orderdate AS order_date,
       o.raw_status AS order_status, o.o_totalprice AS order_total,
       CASE WHEN o.o_custkey % 7 = 0 THEN NULL WHEN o.o_custkey % 5 = 0 THEN 'EUR' ELSE 'RON' END
         AS currency,
       CAST(li.l_partkey AS VARCHAR) AS product_id, li.p_brand AS product_sku,
       li.p_name AS product_name, li.p_retailprice AS product_price,
       li.l_quantity AS product_quantity, li.l_extendedprice AS product_total
FROM o LEFT JOIN li ON li.ok = o.ok WHERE o.platform = 'woocommerce'""")
    q["json_mappings_applied"] = q["apply_mapping"]
    return q


# ---------------------------------------------------------------------------
# Scalar functions
# ---------------------------------------------------------------------------

def _sql_parse_money(text: str) -> str:
    s = f"regexp_replace({text}, '[^0-9.\\-]+', '', 'g')"
    m = f"regexp_extract({s}, '^(-?(?:[0-9]+\\.?[0-9]*|\\.[0-9]+))', 1)"
    v = f"TRY_CAST({m} AS DOUBLE)"
    return f"(CASE WHEN {v} IS NULL OR isnan({v}) OR {v} = 0 THEN 0.0 ELSE {v} END + 0.0)"


def _sql_parse_qty(text: str) -> str:
    t = f"regexp_replace({text}, '^\\s+', '')"
    m = (f"regexp_extract({t}, '^([+-]?(?:Infinity|(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)"
         f"(?:[eE][+-]?[0-9]+)?))', 1)")
    v = f"TRY_CAST({m} AS DOUBLE)"
    return f"(CASE WHEN {v} IS NULL OR isnan({v}) OR {v} = 0 THEN 0.0 ELSE {v} END + 0.0)"


def function_sql() -> dict[str, str]:
    from shopfold.plans.q_functions import EVENTS_AS_OF
    q: dict[str, str] = {}
    k = "json_extract(props, '$.k')"
    q["first_truthy"] = f"""
SELECT event_id,
       CASE WHEN json_type({k}) IN ('BIGINT', 'UBIGINT', 'DOUBLE')
                 AND CAST({k} AS DOUBLE) <> 0 THEN json_extract_string(props, '$.k')
            WHEN json_type({k}) = 'VARCHAR' AND json_extract_string(props, '$.k') <> ''
                 THEN json_extract_string(props, '$.k')
            WHEN json_type({k}) = 'BOOLEAN' AND CAST({k} AS BOOLEAN) THEN 'true'
            WHEN json_type({k}) IN ('OBJECT', 'ARRAY') THEN CAST({k} AS VARCHAR)
            ELSE 'none' END AS k_text
FROM events"""
    q["to_text"] = """
SELECT event_id, CASE WHEN value IS NULL THEN NULL WHEN value = 0 THEN '0'
                      ELSE regexp_replace(CAST(value AS VARCHAR), '\\.0$', '') END AS value_text
FROM events"""
    money_text = """CASE l_linenumber % 5
      WHEN 0 THEN CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || ' lei'
      WHEN 1 THEN CAST((cents // 100) // 1000 AS VARCHAR) || '.' ||
                  lpad(CAST((cents // 100) % 1000 AS VARCHAR), 3, '0') || ',' ||
                  lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
      WHEN 2 THEN '--' || CAST(cents // 100 AS VARCHAR)
      WHEN 3 THEN CAST(cents // 100 AS VARCHAR) || 'e5'
      ELSE 'RON -' || CAST(cents // 100 AS VARCHAR) || '.5' END"""
    q["parse_money"] = f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey,
                  CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem),
u AS (SELECT l_orderkey, l_linenumber, l_partkey, {money_text} AS text FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, text, {_sql_parse_money('text')} AS value FROM u"""
    qty_text = """CASE l_linenumber % 4
      WHEN 0 THEN ' ' || q || ' kg' WHEN 1 THEN q || ',5' WHEN 2 THEN q || 'e1' ELSE 'x' || q END"""
    q["parse_qty"] = f"""
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey,
                  CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q FROM lineitem),
u AS (SELECT l_orderkey, l_linenumber, l_partkey, {qty_text} AS text FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, text, {_sql_parse_qty('text')} AS value FROM u"""
    q["js_round2"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey,
       {r2('l_extendedprice * (1.0 - l_discount)')} AS rounded FROM lineitem"""
    q["line_total"] = f"""
WITH j AS (SELECT l.*, p.p_retailprice,
                  CASE l_orderkey % 3 WHEN 0 THEN 'woocommerce' WHEN 1 THEN 'gomag'
                       ELSE 'merchantpro' END AS platform
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)
SELECT l_orderkey, l_linenumber, l_partkey, platform,
       {r2('''CASE platform WHEN 'woocommerce' THEN l_extendedprice
              WHEN 'merchantpro' THEN CASE WHEN l_linenumber % 2 = 1 AND l_extendedprice <> 0
                   THEN l_extendedprice ELSE p_retailprice * l_quantity END
              ELSE p_retailprice * l_quantity END''')} AS product_total
FROM j"""
    slug = ("regexp_replace(regexp_replace(lower(c_name || ' / ' || c_mktsegment), "
            "'[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')")
    q["slugify"] = f"""
SELECT c_custkey, {slug} AS slug, 'orders_' || replace({slug}, '-', '_') AS table_name
FROM customer"""
    q["format_duration"] = "WITH " + history_cte() + """
SELECT site_id, started_at,
       CASE WHEN duration_seconds * 7 < 60 THEN CAST(duration_seconds * 7 AS VARCHAR) || 's'
            ELSE CAST((duration_seconds * 7) // 60 AS VARCHAR) || 'm ' ||
                 CAST((duration_seconds * 7) % 60 AS VARCHAR) || 's' END AS label
FROM history"""
    mins = f"CAST(floor((epoch_ms(TIMESTAMP '{EVENTS_AS_OF}') - epoch_ms(ts)) / 60000) AS BIGINT)"
    q["relative_time"] = f"""
SELECT event_id,
       CASE WHEN ts IS NULL THEN ''
            WHEN {mins} < 1 THEN 'just now'
            WHEN {mins} < 60 THEN CAST({mins} AS VARCHAR) || 'm ago'
            WHEN floor({mins} / 60) < 24 THEN CAST(CAST(floor({mins} / 60) AS BIGINT) AS VARCHAR) || 'h ago'
            ELSE strftime(ts, '%d.%m.%Y') END AS label
FROM events"""
    q["truncate_sample"] = """
SELECT doc_id, CASE WHEN text IS NULL THEN '—'
                    WHEN length(text) > 60 THEN substr(text, 1, 57) || '…' ELSE text END AS sample
FROM documents"""
    q["transforms"] = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(l.l_partkey AS VARCHAR) AS as_string,
       CAST(CAST(l.l_quantity AS BIGINT) AS DOUBLE) AS as_number, l.l_shipdate AS as_date,
       CAST(len(string_split(p.p_brand || ',' || p.p_type, ',')) AS INTEGER) AS n_parts,
       split_part(p.p_brand || ',' || p.p_type, ',', 1) AS first_part
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""
    return q


# ---------------------------------------------------------------------------
# Tables, streaming, Shopify
# ---------------------------------------------------------------------------

# Site ids that Spark escapes in directory names (see q_tables.rename_site).
SITE_RENAMED = "replace(source_site, 'store_', 'c:d/100% ') AS source_site"


def table_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["append_rows"] = with_base(f"x AS (SELECT 1) SELECT {FACT} FROM flat")
    q["ensure_table"] = with_base(
        "x AS (SELECT 1) SELECT source_site, count(*) AS row_count FROM flat GROUP BY ALL")
    q["drop_staging"] = f"""SELECT source_site, count(*) AS row_count, CAST(0 AS BIGINT) AS staging_left
FROM ({sql_catalog_core()["merge_upsert"]}) GROUP BY ALL"""
    moved = (f"CASE WHEN source_site = '{fx.RUN_SITE}' AND order_date BETWEEN {ts(fx.MOVED_FROM)} AND "
             f"{ts(fx.MOVED_TO)} THEN order_date ELSE order_date - INTERVAL 40 DAY END")
    q["merge_moved_months"] = with_base(DEDUP + f""" SELECT {FACT.replace("order_date", moved + " AS order_date")},
       strftime({moved}, '%Y-%m') AS order_month FROM dedup""")
    q["merge_named_sites"] = with_base(DEDUP + f""" SELECT {FACT.replace("source_site", SITE_RENAMED)} FROM dedup""")
    q["truncate_all"] = with_base(sites_cte() + """
SELECT site_id, 'truncated' AS status, CAST(0 AS BIGINT) AS rows_after,
       (SELECT count(*) FROM flat f WHERE f.source_site = s.site_id) AS rows_again FROM sites s""")
    q["export_csv"] = with_base(f"x AS (SELECT 1) SELECT {FACT} FROM flat")
    q["stream_upsert"] = with_base(DEDUP + f" SELECT {FACT} FROM dedup")
    q["late_status_updates"] = with_base(MERGE_INPUTS.replace(
        f"SELECT * FROM norm WHERE order_date >= {ts(fx.SOURCE_START)}", "SELECT * FROM norm")
        + STATUS_MERGE_BODY)
    q["flatten_shopify"] = f"""
WITH li AS (
  SELECT l.l_orderkey AS ok, l.l_partkey, l.l_quantity, coalesce(p.p_brand, '') AS p_brand,
         coalesce(p.p_name, '') AS p_name, p.p_retailprice
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
o AS (
  SELECT o_orderkey AS ok, CASE WHEN o_orderkey = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END
           AS order_id,
         o_orderdate - INTERVAL 2 HOUR AS order_date,
         CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'P' THEN 'partially_fulfilled'
              ELSE 'unfulfilled' END AS order_status,
         {r2('o_totalprice')} AS order_total,
         CASE WHEN o_custkey % 7 = 0 THEN 'RON' WHEN o_custkey % 5 = 0 THEN 'EUR' ELSE 'RON' END
           AS currency,
         'shop_' || CAST(o_orderkey % 2 AS VARCHAR) AS source_site
  FROM orders
)
SELECT o.order_id, o.order_date, o.order_status, o.order_total, o.currency,
       CASE WHEN li.l_partkey = 0 THEN '' ELSE CAST(li.l_partkey AS VARCHAR) END AS product_id,
       li.p_brand AS product_sku, li.p_name AS product_name, {r2('li.p_retailprice')} AS product_price,
       CAST(li.l_quantity AS BIGINT) AS product_quantity,
       {r2('li.p_retailprice * CAST(CAST(li.l_quantity AS BIGINT) AS DOUBLE)')} AS product_total,
       o.source_site, {AS_OF} AS synced_at
FROM o JOIN li ON li.ok = o.ok
UNION ALL
SELECT o.order_id, o.order_date, o.order_status, o.order_total, o.currency, '', '', '', 0.0,
       CAST(0 AS BIGINT), 0.0, o.source_site, {AS_OF}
FROM o WHERE NOT EXISTS (SELECT 1 FROM li WHERE li.ok = o.ok)"""
    return q
