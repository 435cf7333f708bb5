"""SQL twins of the registered queries, for DuckDB over the same given tables.

Each twin is a chain of named steps from the given tables to the result.  Money and scores
are carried as whole cents and rounded by integer division, so that no double is rounded.
"""

from __future__ import annotations

from tidemark.functions.keys import NULL_KEY_PART
from tidemark.functions.text import (
    HOTEL_KINDS, RENAMED_HOMES, ROOM_PREFIXES, STANDALONE_HOMES, SUBURB_ALIASES, WHOLE_HOME,
)
from tidemark.operators import quality
from tidemark.operators.geography import SUBURB_OVERRIDES
from tidemark.sources.raw import RAW_LISTINGS, SCORES

from .adapter import (
    CUTOFF, EMPTY_LGA, EXTRA_LGAS, EXTRA_SUBURBS, FIRST_YEAR, PLACES, PROPERTY_TYPES, ROOM_TYPES,
    SCORE_STEPS,
)
from .queries import RULES, RUN_1, RUN_1_LAST_MONTH, RUN_2

STEPS: dict[str, tuple[list[str], str]] = {}


def step(name: str, needs: str, sql: str) -> None:
    STEPS[name] = (needs.split(), sql)


def chain(needs: str, final: str) -> str:
    """``final`` behind the steps it needs, in the order they were declared."""
    used: set[str] = set()
    todo = needs.split()
    while todo:
        name = todo.pop()
        if name not in used:
            used.add(name)
            todo += STEPS[name][0]
    ctes = ",\n".join(f"{n} AS (\n{s}\n)" for n, (_, s) in STEPS.items() if n in used)
    return f"WITH {ctes}\n{final}"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(rows, *columns: str) -> str:
    body = ", ".join("(" + ", ".join(q(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS v({', '.join(columns)})"


def nth(index: str, options) -> str:
    return f"([{', '.join(q(o) for o in options)}])[{index} + 1]"


def text(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c.split('.')[-1]}" for c in columns)


def dbl(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}" for c in columns)


def half_up(cents: str, over: str) -> str:
    """``cents / over`` in whole cents, halves away from zero, as a double of units."""
    top, low = f"CAST({cents} AS HUGEINT)", f"CAST(NULLIF({over}, 0) AS HUGEINT)"
    return (f"CAST(sign({cents}) * ((2 * abs({top}) + {low}) // (2 * {low})) AS DOUBLE) / 100")


# ---- raw ----------------------------------------------------------------------------

step("monthly_items", "", f"""
  SELECT l_partkey + 1 AS listing_id, date_trunc('month', l_shipdate) AS month,
         (year(l_shipdate) - {FIRST_YEAR}) * 12 + month(l_shipdate) - 1 AS mi,
         CAST(min(l_shipdate) AS DATE) AS day, min(l_suppkey) + 1 AS host_id,
         CAST(min(l_quantity) AS INTEGER) AS quantity
  FROM lineitem GROUP BY ALL""")

_five = "\n".join(
    f"         , CAST(CASE WHEN listing_id % 9 <> 0 THEN 1 + (listing_id + {k} * mi) % 10 END "
    f"AS DECIMAL(5,2)) AS {c}" for c, k in zip(SCORES[1:], SCORE_STEPS, strict=True))

step("raw_listings", "monthly_items", f"""
  SELECT listing_id, CAST(1000000 + mi AS BIGINT) AS scrape_id,
         strftime(month, '%m_%Y') AS source_month,
         CAST(CAST(day + CASE WHEN (listing_id + mi) % 13 = 0 THEN 40 ELSE 0 END AS DATE)
              AS VARCHAR) AS scraped_date,
         host_id,
         CASE WHEN gap THEN NULL WHEN host_id % 17 = 0 THEN '  '
              ELSE ' ' || s_name || ' ' END AS host_name,
         CASE WHEN NOT gap THEN printf('%02d/%02d/2012', 1 + host_id % 28, 1 + host_id % 12) END
           AS host_since,
         CASE WHEN gap THEN NULL WHEN (host_id + mi // 6) % 2 = 0 THEN 't' ELSE 'f' END
           AS host_is_superhost,
         CASE WHEN host_id % 19 = 0 THEN NULL WHEN host_id % 23 = 0 THEN ' '
              WHEN host_id % 29 = 0 THEN 'Waverly' WHEN host_id % 31 = 0 THEN 'Enmore'
              WHEN host_id % 41 = 0 THEN 'Overseas'
              ELSE ' Nation_' || CAST((s_nationkey + mi // 24) % 25 AS VARCHAR) END
           AS host_neighbourhood,
         CASE WHEN listing_id % 47 = 0 THEN 'Nowhere' ELSE {nth('p_size % 5', PLACES)} END
           AS listing_neighbourhood,
         {nth('p_size % 9', PROPERTY_TYPES)} AS property_type,
         {nth('listing_id % 5', ROOM_TYPES)} AS room_type,
         CAST(1 + p_size % 8 + CASE WHEN mi >= 40 AND listing_id % 6 = 0 THEN 1 ELSE 0 END
              AS INTEGER) AS accommodates,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) + mi * CAST(0.01 AS DECIMAL(3,2))
              AS DECIMAL(12,2)) AS price,
         CASE WHEN (listing_id + mi) % 7 = 0 THEN 'f' WHEN (listing_id + mi) % 29 = 0 THEN NULL
              ELSE 't' END AS has_availability,
         CAST(quantity % 31 AS INTEGER) AS availability_30,
         CAST((listing_id * mi) % 300 AS INTEGER) AS number_of_reviews,
         CAST(CASE WHEN listing_id % 9 <> 0 THEN 60 + (listing_id + mi) % 41 END
              AS DECIMAL(5,2)) AS review_scores_rating
{_five}
  FROM (SELECT i.*, p.p_size, p.p_retailprice, s.s_name, s.s_nationkey,
               i.host_id % 37 = 0 OR (i.listing_id + 7 * i.host_id + i.mi) % 11 = 0 AS gap
        FROM monthly_items i
        JOIN part p ON p.p_partkey + 1 = i.listing_id
        JOIN supplier s ON s.s_suppkey + 1 = i.host_id)""")

step("peopled", "", """
  SELECT CAST(10000 + 10 * r_regionkey AS VARCHAR) AS code, r_name, n_name,
         count(*) AS people, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS sum_bal,
         min(CAST(c_acctbal AS DECIMAL(18,2))) AS min_bal,
         max(CAST(c_acctbal AS DECIMAL(18,2))) AS max_bal
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL""")

step("raw_lga", "peopled", f"""
  SELECT DISTINCT code AS lga_code,
         ' ' || upper(left(r_name, 1)) || lower(substr(r_name, 2)) || ' ' AS lga_name FROM peopled
  UNION ALL SELECT * FROM {values(EXTRA_LGAS, 'lga_code', 'lga_name')}""")

step("raw_suburb", "peopled", f"""
  SELECT lower(n_name) || ' ' AS suburb_name, r_name AS lga_name FROM peopled
  UNION ALL SELECT * FROM {values(EXTRA_SUBURBS, 'suburb_name', 'lga_name')}""")

step("raw_g01", "peopled", f"""
  SELECT 'LGA' || code AS lga_code_2016, CAST(sum(people) AS BIGINT) AS tot_p,
         CAST(sum(sum_bal) AS DECIMAL(18,2)) AS sum_bal FROM peopled GROUP BY code
  UNION ALL SELECT {q(EMPTY_LGA)}, 0, 0""")

step("raw_g02", "peopled", f"""
  SELECT 'LGA' || code AS lga_code_2016, min(min_bal) AS min_bal, max(max_bal) AS max_bal
  FROM peopled GROUP BY code
  UNION ALL SELECT {q(EMPTY_LGA)}, 0, 0""")

# ---- bronze and silver --------------------------------------------------------------

step("bronze", "raw_listings", f"""
  SELECT md5(coalesce(CAST(listing_id AS VARCHAR), {q(NULL_KEY_PART)}) || '-'
             || coalesce(source_month, {q(NULL_KEY_PART)})) AS listing_row_id, *
  FROM raw_listings""")

step("room_prefix", "", f"SELECT * FROM {values(ROOM_PREFIXES.items(), 'room', 'prefix')}")
step("home_names", "", f"""
  SELECT * FROM {values([(h, h) for h in STANDALONE_HOMES] + list(RENAMED_HOMES.items()),
                        'kind', 'name')}""")
step("suburb_alias", "", f"SELECT * FROM {values(SUBURB_ALIASES.items(), 'written', 'meant')}")

step("dated", "bronze", """
  SELECT *, CAST(strptime('01_' || source_month, '%d_%m_%Y') AS DATE) AS listing_month,
         last_day(strptime('01_' || source_month, '%d_%m_%Y')) AS month_end,
         CAST(scraped_date AS DATE) AS seen
  FROM bronze""")

_hotels = ", ".join(q(h) for h in HOTEL_KINDS)
step("silver", "dated room_prefix home_names suburb_alias", f"""
  SELECT b.listing_row_id, b.listing_id, b.host_id, b.source_month, b.listing_month,
         CASE WHEN b.seen > b.month_end THEN b.month_end ELSE coalesce(b.seen, b.month_end) END
           AS scraped_date,
         b.seen AS scraped_date_raw, b.seen > b.month_end AS is_scraped_date_fixed,
         nullif(trim(b.host_name), '') AS host_name,
         CAST(strptime(b.host_since, '%d/%m/%Y') AS DATE) AS host_since,
         CASE b.host_is_superhost WHEN 't' THEN TRUE WHEN 'f' THEN FALSE END AS host_is_superhost,
         coalesce(a.meant, nullif(upper(trim(b.host_neighbourhood)), '')) AS host_neighbourhood,
         trim(b.listing_neighbourhood) AS listing_neighbourhood,
         CASE WHEN b.seen >= DATE {q(CUTOFF)} THEN b.property_type
              WHEN b.property_type IN ({_hotels}) THEN 'Room in ' || lower(b.property_type)
              WHEN b.room_type = {q(WHOLE_HOME)}
                THEN coalesce(h.name, 'Entire ' || lower(b.property_type))
              WHEN b.property_type = 'Other' THEN b.room_type
              ELSE coalesce(r.prefix || lower(b.property_type), b.property_type) END
           AS property_type,
         b.property_type AS property_type_raw, b.room_type, b.accommodates, b.price,
         CASE b.has_availability WHEN 't' THEN TRUE WHEN 'f' THEN FALSE END AS has_availability,
         b.availability_30, b.number_of_reviews, {', '.join('b.' + c for c in SCORES)}
  FROM dated b
  LEFT JOIN room_prefix r ON r.room = b.room_type
  LEFT JOIN home_names h ON h.kind = b.property_type
  LEFT JOIN suburb_alias a ON a.written = upper(trim(b.host_neighbourhood))""")

step("silver_1", "silver",
     f"  SELECT * FROM silver WHERE listing_month <= DATE {q(RUN_1_LAST_MONTH)}")
step("overrides", "",
     f"  SELECT * FROM {values(SUBURB_OVERRIDES, 'suburb_name', 'lga_name', 'lga_name_in_file')}")
step("lga", "raw_lga", """
  SELECT trim(lga_code) AS lga_code, trim(lga_name) AS lga_name,
         upper(trim(lga_name)) AS lga_name_upper FROM raw_lga""")
step("suburb_1", "raw_suburb", """
  SELECT upper(trim(suburb_name)) AS suburb_name, upper(trim(lga_name)) AS lga_name
  FROM raw_suburb""")
step("suburb_2", "suburb_1 overrides", """
  SELECT s.suburb_name, CASE WHEN o.suburb_name IS NULL THEN s.lga_name ELSE o.lga_name END
           AS lga_name, s.lga_name AS lga_name_in_file, o.suburb_name IS NOT NULL AS is_corrected
  FROM suburb_1 s LEFT JOIN overrides o USING (suburb_name)""")

# ---- history ------------------------------------------------------------------------

HOST = ("host_name", "host_since", "host_is_superhost", "host_neighbourhood")
LISTING = ("property_type", "room_type", "accommodates", "listing_neighbourhood")


def _differs(attributes, w: str) -> str:
    return " OR ".join(f"{a} IS DISTINCT FROM lag({a}) OVER {w}" for a in attributes)


def _history(entity: str, key: str, attributes, source: str, suffix: str, kept: str,
             order: str) -> None:
    """Steps <entity>_monthly, _versions, _latest and _history over ``source``."""
    cols = ", ".join(attributes)
    n = f"{entity}_%s{suffix}"
    step(n % "first", source, f"""
  SELECT {key}, listing_month, min(scraped_date) AS first_date FROM {source}
  WHERE {key} IS NOT NULL GROUP BY ALL""")
    step(n % "monthly", f"{n % 'first'} {kept}", f"""
  SELECT k.{key}, k.listing_month, f.first_date, {cols}
  FROM {kept} k JOIN {n % 'first'} f USING ({key}, listing_month)
  QUALIFY row_number() OVER (PARTITION BY k.{key}, k.listing_month ORDER BY {order}) = 1""")
    step(n % "marked", n % "monthly", f"""
  SELECT *, CASE WHEN lag(listing_month) OVER w IS NULL OR {_differs(attributes, 'w')}
                 THEN 1 ELSE 0 END AS is_change
  FROM {n % 'monthly'} WINDOW w AS (PARTITION BY {key} ORDER BY listing_month)""")
    step(n % "versions", n % "marked", f"""
  SELECT *, CAST(sum(is_change) OVER (PARTITION BY {key} ORDER BY listing_month
                                      ROWS UNBOUNDED PRECEDING) AS BIGINT) AS version_no
  FROM {n % 'marked'}""")
    step(n % "latest", n % "versions", f"""
  SELECT v.{key}, {', '.join('v.' + a for a in attributes)}, v.listing_month,
         (SELECT min(x.first_date) FROM {n % 'versions'} x
          WHERE x.{key} = v.{key} AND x.version_no = v.version_no) AS updated_at
  FROM {n % 'versions'} v
  WHERE v.listing_month = (SELECT max(y.listing_month) FROM {n % 'versions'} y
                           WHERE y.{key} = v.{key})""")
    step(n % "history", n % "versions", f"""
  SELECT {key}, {cols}, CAST(first_date AS TIMESTAMP) AS valid_from,
         CAST(lead(first_date) OVER (PARTITION BY {key} ORDER BY listing_month) AS TIMESTAMP)
           AS valid_to
  FROM {n % 'versions'} WHERE is_change = 1""")


for _src, _sfx in (("silver", ""), ("silver_1", "_1")):
    _gap = "host_name IS NULL AND host_since IS NULL AND host_is_superhost IS NULL"
    step(f"host_kept{_sfx}", _src, f"""
  SELECT * FROM {_src} WHERE host_id IS NOT NULL AND (NOT ({_gap})
    OR host_id NOT IN (SELECT host_id FROM {_src} WHERE NOT ({_gap}) AND host_id IS NOT NULL))""")
    _history("host", "host_id", HOST, _src, _sfx, f"host_kept{_sfx}",
             "scraped_date, listing_id")
    step(f"listing_kept{_sfx}", _src, f"  SELECT * FROM {_src} WHERE listing_id IS NOT NULL")
    _history("listing", "listing_id", LISTING, _src, _sfx, f"listing_kept{_sfx}",
             "scraped_date")


def _two_runs(name: str, key: str, columns, stage_1: str, stage_2: str, stamp_1: str,
              stamp_2: str, changed: str) -> None:
    """Snapshot ``name`` after two merges; ``changed`` compares old ``o`` with new ``n``."""
    old = ", ".join(f"o.{c}" for c in columns)
    new = ", ".join(f"n.{c}" for c in columns)
    fresh = "md5(CAST(n.{0} AS VARCHAR) || '|' || CAST(n.stamp AS VARCHAR))".format(key)
    step(f"{name}_in1", stage_1, f"  SELECT *, CAST({stamp_1} AS TIMESTAMP) AS stamp FROM {stage_1}")
    step(f"{name}_in2", stage_2, f"  SELECT *, CAST({stamp_2} AS TIMESTAMP) AS stamp FROM {stage_2}")
    step(name, f"{name}_in1 {name}_in2", f"""
  SELECT {old}, {fresh.replace('n.', 'o.')} AS scd_id, o.stamp AS scd_updated_at,
         o.stamp AS valid_from, CASE WHEN {changed} THEN n.stamp END AS valid_to
  FROM {name}_in1 o LEFT JOIN {name}_in2 n USING ({key})
  UNION ALL
  SELECT {new}, {fresh}, n.stamp, n.stamp, NULL
  FROM {name}_in2 n LEFT JOIN {name}_in1 o USING ({key})
  WHERE o.{key} IS NULL OR {changed}""")


_two_runs("host_snap", "host_id", ("host_id", *HOST), "host_latest_1", "host_latest",
          "updated_at", "updated_at", "n.stamp > o.stamp")
_two_runs("listing_snap", "listing_id", ("listing_id", *LISTING), "listing_latest_1",
          "listing_latest", "updated_at", "updated_at", "n.stamp > o.stamp")
_two_runs("lga_snap", "lga_code", ("lga_code", "lga_name", "lga_name_upper"), "lga", "lga",
          q(str(RUN_1)), q(str(RUN_2)), "n.lga_name IS DISTINCT FROM o.lga_name")
_two_runs("suburb_snap", "suburb_name", ("suburb_name", "lga_name"), "suburb_1", "suburb_2",
          q(str(RUN_1)), q(str(RUN_2)), "n.lga_name IS DISTINCT FROM o.lga_name")

# ---- star ---------------------------------------------------------------------------


def _dim(name: str, snap: str, key: str, attributes, unknown: str) -> None:
    cols = ", ".join(attributes)
    step(name, snap, f"""
  SELECT {unknown}, TIMESTAMP '1900-01-01 00:00:00' AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to
  UNION ALL
  SELECT {key}, {cols},
         CASE WHEN valid_from = min(valid_from) OVER (PARTITION BY {key})
              THEN TIMESTAMP '1900-01-01 00:00:00' ELSE valid_from END, valid_to
  FROM {snap}""")


_unknown_host = ("0 AS host_id, 'Unknown' AS host_name, CAST(NULL AS DATE) AS host_since, "
                 "CAST(NULL AS BOOLEAN) AS host_is_superhost, 'UNKNOWN' AS host_neighbourhood")
_dim("dim_host", "host_snap", "host_id", HOST, _unknown_host)
_dim("dim_host_full", "host_history", "host_id", HOST, _unknown_host)
_dim("dim_listing", "listing_snap", "listing_id", LISTING,
     "0 AS listing_id, 'Unknown' AS property_type, 'Unknown' AS room_type, "
     "CAST(NULL AS INTEGER) AS accommodates, 'Unknown' AS listing_neighbourhood")
_dim("dim_lga", "lga_snap", "lga_code", ("lga_name", "lga_name_upper"),
     "'0' AS lga_code, 'Unknown' AS lga_name, 'UNKNOWN' AS lga_name_upper")
_dim("dim_suburb", "suburb_snap", "suburb_name", ("lga_name",),
     "'UNKNOWN' AS suburb_name, 'UNKNOWN' AS lga_name")


def during(fact: str, version: str) -> str:
    return (f"{fact}.scraped_date >= {version}.valid_from AND ({version}.valid_to IS NULL "
            f"OR {fact}.scraped_date < {version}.valid_to)")


step("fact", "silver dim_listing dim_host dim_lga dim_suburb", f"""
  SELECT s.listing_row_id,
         CASE WHEN EXISTS (SELECT 1 FROM dim_listing d WHERE d.listing_id = s.listing_id)
              THEN s.listing_id ELSE 0 END AS listing_id,
         CASE WHEN EXISTS (SELECT 1 FROM dim_host d WHERE d.host_id = s.host_id)
              THEN s.host_id ELSE 0 END AS host_id,
         coalesce(l.lga_code, '0') AS listing_lga_code,
         CASE WHEN EXISTS (SELECT 1 FROM dim_suburb d WHERE d.suburb_name = s.host_neighbourhood)
              THEN s.host_neighbourhood ELSE 'UNKNOWN' END AS host_suburb,
         s.scraped_date, s.listing_month,
         CASE WHEN s.has_availability IS TRUE THEN 1 ELSE 0 END AS is_active,
         s.price, s.availability_30, s.number_of_reviews, {', '.join('s.' + c for c in SCORES)}
  FROM silver s
  LEFT JOIN dim_lga l ON l.lga_code <> '0'
       AND l.lga_name_upper = upper(trim(s.listing_neighbourhood)) AND {during('s', 'l')}""")

# ---- marts --------------------------------------------------------------------------

step("measured", "fact", """
  SELECT *, listing_month AS month_year, CAST(price * 100 AS BIGINT) AS cents,
         CAST(review_scores_rating * 100 AS BIGINT) AS score_cents,
         CASE WHEN is_active = 1 THEN 30 - availability_30 END AS stays
  FROM fact""")


def _mart(name: str, source: str, group: str) -> None:
    step(f"{name}_monthly", source, f"""
  SELECT {group}, month_year, count(*) AS total, count(*) FILTER (is_active = 1) AS active,
         count(*) FILTER (is_active = 0) AS inactive,
         min(price) FILTER (is_active = 1) AS min_price,
         max(price) FILTER (is_active = 1) AS max_price,
         quantile_disc(cents, 0.5) FILTER (is_active = 1) AS low_cents,
         -quantile_disc(-cents, 0.5) FILTER (is_active = 1) AS high_cents,
         sum(cents) FILTER (is_active = 1) AS price_cents,
         count(cents) FILTER (is_active = 1) AS prices,
         sum(score_cents) FILTER (is_active = 1) AS score_cents,
         count(score_cents) FILTER (is_active = 1) AS scores,
         count(DISTINCT host_id) AS distinct_hosts,
         count(DISTINCT host_id) FILTER (host_is_superhost) AS superhosts,
         coalesce(sum(stays), 0) AS total_stays, sum(stays * cents) AS revenue_cents
  FROM {source} GROUP BY ALL""")
    keys = [g.strip() for g in group.split(",")]
    same = " AND ".join(f"p.{k} IS NOT DISTINCT FROM m.{k}" for k in keys)
    step(f"{name}_paired", f"{name}_monthly", f"""
  SELECT m.*, p.active AS active_before, p.inactive AS inactive_before
  FROM {name}_monthly m LEFT JOIN {name}_monthly p
       ON {same} AND p.month_year + INTERVAL 1 MONTH = m.month_year""")


def _mart_final(name: str, group: str) -> str:
    return f"""
SELECT {group}, {text('month_year')},
       {half_up('10000 * active', 'total')} AS active_listings_rate,
       {dbl('min_price', 'max_price')},
       {half_up('low_cents + high_cents', '2')} AS median_price,
       {half_up('price_cents', 'prices')} AS avg_price,
       distinct_hosts,
       {half_up('10000 * superhosts', 'distinct_hosts')} AS superhost_rate,
       {half_up('score_cents', 'scores')} AS avg_review_scores_rating,
       {half_up('10000 * (active - active_before)', 'active_before')}
         AS active_listings_pct_change,
       {half_up('10000 * (inactive - inactive_before)', 'inactive_before')}
         AS inactive_listings_pct_change,
       CAST(total_stays AS BIGINT) AS total_stays,
       {half_up('revenue_cents', 'active')} AS avg_estimated_revenue_per_active_listing
FROM {name}_paired"""


step("by_lga", "measured dim_lga dim_host", f"""
  SELECT coalesce(l.lga_name, 'Unknown') AS listing_neighbourhood, h.host_is_superhost, f.*
  FROM measured f
  LEFT JOIN dim_lga l ON l.lga_code = f.listing_lga_code AND {during('f', 'l')}
  LEFT JOIN dim_host h ON h.host_id = f.host_id AND {during('f', 'h')}""")
_mart("lga_mart", "by_lga", "listing_neighbourhood")

step("by_property", "measured dim_listing dim_host", f"""
  SELECT coalesce(d.property_type, 'Unknown') AS property_type,
         coalesce(d.room_type, 'Unknown') AS room_type, d.accommodates,
         h.host_is_superhost, f.*
  FROM measured f
  LEFT JOIN dim_listing d ON d.listing_id = f.listing_id AND {during('f', 'd')}
  LEFT JOIN dim_host h ON h.host_id = f.host_id AND {during('f', 'h')}""")
_mart("property_mart", "by_property", "property_type, room_type, accommodates")

step("by_suburb", "measured dim_suburb dim_lga", f"""
  SELECT coalesce(l.lga_name, 'Unknown') AS host_neighbourhood_lga, f.*
  FROM measured f
  LEFT JOIN dim_suburb s ON s.suburb_name = f.host_suburb AND {during('f', 's')}
  LEFT JOIN dim_lga l ON l.lga_name_upper = s.lga_name AND {during('f', 'l')}""")

step("host_mart", "by_suburb", """
  SELECT host_neighbourhood_lga, month_year, count(DISTINCT host_id) AS distinct_hosts,
         sum(is_active) AS active, sum(stays * cents) AS revenue_cents
  FROM by_suburb GROUP BY ALL""")

# ---- data quality -------------------------------------------------------------------

_TABLES = {
    "silver.listings": "silver", "silver.host": "host_latest",
    "silver.listing_latest": "listing_latest", "silver.nsw_lga_suburb": "suburb_2",
    "silver.nsw_lga_code": "lga", "gold.dim_listing": "dim_listing", "gold.dim_host": "dim_host",
    "gold.dim_lga": "dim_lga", "gold.dim_suburb": "dim_suburb", "gold.fact_listings": "fact",
    "mart.listing_neighbourhood": "lga_mart_monthly", "mart.property_type": "property_mart_monthly",
    "mart.host_neighbourhood": "host_mart",
}


def _literal(v) -> str:
    return q(v) if isinstance(v, str) else str(v)


def _violations(r: quality.Rule) -> str:
    t, c = _TABLES[r.table], ", ".join(r.columns)
    if r.kind == quality.NOT_NULL:
        return f"SELECT count(*) FROM {t} WHERE {c} IS NULL"
    if r.kind == quality.UNIQUE:
        return (f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING count(*) > 1)")
    if r.kind == quality.UNIQUE_COMBINATION:
        return f"SELECT count(*) FROM (SELECT {c} FROM {t} GROUP BY {c} HAVING count(*) > 1)"
    if r.kind == quality.RELATIONSHIPS:
        return (f"SELECT count(*) FROM {t} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {_TABLES[r.parent]} y WHERE y.{r.parent_column} = x.{c})")
    if r.kind == quality.ACCEPTED_VALUES:
        return (f"SELECT count(*) FROM {t} "
                f"WHERE {c} NOT IN ({', '.join(_literal(v) for v in r.values)})")
    bounds = [f"{c} {op} {v}" for op, v in (("<", r.low), (">", r.high)) if v is not None]
    return f"SELECT count(*) FROM {t} WHERE {' OR '.join(bounds)}"


def _dq_sql(rules) -> str:
    used = {_TABLES[r.table] for r in rules} | {_TABLES[r.parent] for r in rules if r.parent}
    rows = "\nUNION ALL\n".join(
        f"SELECT {q(r.table)} AS table_name, {q(r.kind)} AS rule, {q(r.label)} AS column_name, "
        f"({_violations(r)}) AS violations" for r in rules)
    return chain(" ".join(sorted(used)),
                 f"SELECT *, violations = 0 AS passed FROM (\n{rows}\n)")


# -------------------------------------------------------------------------------------

_DECIMALS = ("price", *SCORES)
_RAW = [dbl(f.name) if f.name in _DECIMALS else f.name for f in RAW_LISTINGS]
_SILVER_DATES = ("listing_month", "scraped_date", "scraped_date_raw", "host_since")


def _silver(*columns: str) -> str:
    shown = [text(c) if c in _SILVER_DATES else c for c in columns]
    return chain("silver", f"SELECT listing_row_id, {', '.join(shown)} FROM silver")


def _host(table: str, *rest: str) -> str:
    return chain(table, f"SELECT host_id, host_name, {text('host_since')}, host_is_superhost, "
                        f"host_neighbourhood, {', '.join(rest)} FROM {table}")


def _listing(table: str, *rest: str) -> str:
    return chain(table, f"SELECT listing_id, property_type, room_type, accommodates, "
                        f"listing_neighbourhood, {', '.join(rest)} FROM {table}")


def oracle_sql() -> dict[str, str]:
    months = text("listing_month", "first_date")
    valid = text("valid_from", "valid_to")
    latest = text("listing_month", "updated_at")
    version = "scd_id, " + text("scd_updated_at", "valid_from", "valid_to")
    stored = {"census_g01": ("raw_g01", "lga_code_2016, tot_p, " + dbl("sum_bal")),
              "census_g02": ("raw_g02", "lga_code_2016, " + dbl("min_bal", "max_bal")),
              "nsw_lga_code": ("raw_lga", "lga_code, lga_name"),
              "nsw_lga_suburb": ("raw_suburb", "suburb_name, lga_name")}
    copies = " UNION ALL BY NAME ".join(f"SELECT {q(t)} AS table_name, {c} FROM {s}"
                                        for t, (s, c) in stored.items())
    return {
        "raw_listings": chain("raw_listings", f"SELECT {', '.join(_RAW)} FROM raw_listings"),
        "bronze_copy": chain("raw_g01 raw_g02 raw_lga raw_suburb", copies),
        "bronze_listings": chain(
            "bronze", f"SELECT listing_row_id, {', '.join(_RAW)} FROM bronze"),
        "surrogate_key": chain(
            "bronze", "SELECT listing_row_id, listing_id, source_month FROM bronze"),
        "date_clamp": _silver("listing_month", "scraped_date", "scraped_date_raw",
                              "is_scraped_date_fixed", "host_since"),
        "flag_decode": _silver("host_is_superhost", "has_availability"),
        "text_clean": _silver("host_name", "host_neighbourhood", "listing_neighbourhood"),
        "property_recode": _silver("property_type", "property_type_raw", "room_type"),
        "silver_listings": _silver(
            "listing_id", "host_id", "source_month", "listing_month", "scraped_date",
            "scraped_date_raw", "is_scraped_date_fixed", "host_name", "host_since",
            "host_is_superhost", "host_neighbourhood", "listing_neighbourhood", "property_type",
            "property_type_raw", "room_type", "accommodates", dbl("price"), "has_availability",
            "availability_30", "number_of_reviews", *[dbl(c) for c in SCORES]),
        "census_g01": chain("raw_g01", "SELECT substr(lga_code_2016, 4) AS lga_code, "
                            f"lga_code_2016, tot_p, {dbl('sum_bal')} FROM raw_g01"),
        "census_g02": chain("raw_g02", "SELECT substr(lga_code_2016, 4) AS lga_code, "
                            f"lga_code_2016, {dbl('min_bal', 'max_bal')} FROM raw_g02"),
        "lga_code": chain("lga", "SELECT * FROM lga"),
        "suburb_override": chain("overrides silver", """
SELECT o.*, (SELECT count(*) FROM silver s WHERE s.host_neighbourhood = o.suburb_name)
         AS listing_rows FROM overrides o"""),
        "suburb_mapping": chain("suburb_2", "SELECT * FROM suburb_2"),
        "host_monthly": _host("host_monthly", months),
        "listing_monthly": _listing("listing_monthly", months),
        "host_versions": _host("host_versions", months, "is_change", "version_no"),
        "listing_versions": _listing("listing_versions", months, "is_change", "version_no"),
        "host_latest": _host("host_latest", latest),
        "listing_latest": _listing("listing_latest", latest),
        "host_history": _host("host_history", valid),
        "listing_history": _listing("listing_history", valid),
        "scd2_timestamp_two_runs": _host(
            "host_snap", "CAST(scd_updated_at AS VARCHAR) AS updated_at", version),
        "scd2_check_two_runs": chain(
            "suburb_snap", f"SELECT suburb_name, lga_name, {version} FROM suburb_snap"),
        "dim_host": _host("dim_host", valid),
        "dim_listing": _listing("dim_listing", valid),
        "dim_lga": chain(
            "dim_lga", f"SELECT lga_code, lga_name, lga_name_upper, {valid} FROM dim_lga"),
        "dim_suburb": chain("dim_suburb", f"SELECT suburb_name, lga_name, {valid} FROM dim_suburb"),
        "key_resolution": chain("silver host_latest_1 dim_suburb", """
SELECT s.listing_row_id, coalesce(h.host_id, 0) AS host_id,
       CASE WHEN s.host_neighbourhood IN (SELECT suburb_name FROM dim_suburb)
            THEN s.host_neighbourhood ELSE 'UNKNOWN' END AS host_suburb
FROM silver s LEFT JOIN host_latest_1 h USING (host_id)"""),
        "asof_join": chain("silver dim_host_full", f"""
SELECT s.listing_row_id, s.host_id, {text('s.scraped_date')}, h.host_is_superhost,
       h.host_neighbourhood AS version_neighbourhood,
       CAST(h.valid_from AS VARCHAR) AS version_from
FROM silver s LEFT JOIN dim_host_full h ON h.host_id = s.host_id AND {during('s', 'h')}"""),
        "fact_listings": chain("fact", f"""
SELECT listing_row_id, listing_id, host_id, listing_lga_code, host_suburb,
       {text('scraped_date', 'listing_month')}, is_active, {dbl('price')}, availability_30,
       number_of_reviews, {dbl(*SCORES)} FROM fact"""),
        "mart_listing_neighbourhood": chain(
            "lga_mart_paired", _mart_final("lga_mart", "listing_neighbourhood")),
        "mart_property_type": chain(
            "property_mart_paired",
            _mart_final("property_mart", "property_type, room_type, accommodates")),
        "mart_host_neighbourhood": chain("host_mart", f"""
SELECT host_neighbourhood_lga, {text('month_year')}, distinct_hosts,
       {half_up('revenue_cents', 'active')} AS avg_estimated_revenue_per_active_listing,
       {half_up('revenue_cents', 'distinct_hosts')} AS estimated_revenue_per_host,
       {half_up('revenue_cents', '1')} AS total_estimated_revenue
FROM host_mart"""),
        "mom_change": chain("fact", f"""
SELECT m.listing_id, CAST(m.listing_month AS VARCHAR) AS listing_month,
       CAST(m.active AS BIGINT) AS active, CAST(m.free_nights AS BIGINT) AS free_nights,
       {half_up('10000 * (m.active - p.active)', 'p.active')} AS active_pct_change,
       {half_up('10000 * (m.free_nights - p.free_nights)', 'p.free_nights')}
         AS free_nights_pct_change
FROM (SELECT listing_id, listing_month, sum(is_active) AS active,
             sum(availability_30) AS free_nights FROM fact GROUP BY ALL) m
LEFT JOIN (SELECT listing_id, listing_month + INTERVAL 1 MONTH AS next_month,
                  sum(is_active) AS active, sum(availability_30) AS free_nights
           FROM fact GROUP BY ALL) p
  ON p.listing_id = m.listing_id AND p.next_month = m.listing_month"""),
        "stay_revenue": chain("measured", """
SELECT listing_row_id, stays, CAST(stays * cents AS DOUBLE) / 100 AS revenue FROM measured"""),
        **{name: _dq_sql(rules) for name, rules in RULES.items()},
    }
