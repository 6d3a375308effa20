"""DuckDB SQL with the same results as the registered queries."""

from __future__ import annotations

from tickloom.plans.queries import MAX_HOURLY_REPEATS, MIN_FILE_ROWS, MIN_SLICE_ROWS, PRICE_STD, STAT_COLUMNS
from tickloom.schema import LEVELS

TICKS = """
shaped AS (
  SELECT event_id AS seq, upper(substr(event_type, 1, 2)) AS category,
    CASE user_id % 6 WHEN 0 THEN '0000' WHEN 5 THEN '9999' ELSE '240' || (user_id % 6)::VARCHAR END AS subID,
    ts, value, regexp_extract(props, '([0-9]+)', 1)::INT AS k
  FROM events),
named AS (
  SELECT category || subID AS InstrumentID, CASE WHEN category = 'CL' THEN 3 ELSE 4 END AS MarketID,
    category, subID, ts AS UpdateTime, value AS LastPrice, (k - 5)::DOUBLE AS LastVolume,
    CASE WHEN seq % 97 = 0 THEN 900000000 ELSE 100000 + seq % 1000 END AS OpenInterest,
    CASE WHEN seq % 11 <> 0 THEN value * k END AS Turnover, value AS AvePrice,
    CASE WHEN seq % 5 = 0 THEN 0.0::DOUBLE ELSE value + 1 END AS HighestPrice,
    CASE WHEN seq % 5 = 0 THEN 0.0::DOUBLE ELSE value - 1 END AS LowestPrice,
    CASE WHEN seq % 5 = 0 THEN 0.0::DOUBLE ELSE value END AS OpenPrice,
    CASE WHEN subID = '9999' THEN category || '2401' END AS mainID,
    seq, strftime(ts, '%Y%m%d') AS day, strftime(ts, '%Y%m') AS month
  FROM shaped),
ticks AS (
  SELECT *, '2024/' || MarketID::VARCHAR || '/' || category || '/' || InstrumentID || '/2024/' || month || '/' || day || '.spt' AS path
  FROM named)
"""

HOUR_LABEL = """CASE WHEN hour(UpdateTime - INTERVAL 200 MINUTE) BETWEEN 4 AND 6 THEN 'fam'
    WHEN hour(UpdateTime - INTERVAL 200 MINUTE) BETWEEN 7 AND 8 THEN 'bam'
    WHEN hour(UpdateTime - INTERVAL 200 MINUTE) BETWEEN 9 AND 14 THEN 'pm'
    WHEN hour(UpdateTime - INTERVAL 200 MINUTE) >= 15 THEN 'night' ELSE 'unknow' END"""

CLOCK_LABEL = """CASE WHEN UpdateTime::TIME BETWEEN TIME '09:00:00' AND TIME '10:15:00' THEN 'fam'
    WHEN UpdateTime::TIME BETWEEN TIME '10:30:00' AND TIME '11:30:00' THEN 'bam'
    WHEN UpdateTime::TIME BETWEEN TIME '13:00:00' AND TIME '15:01:00' THEN 'pm'
    WHEN UpdateTime::TIME >= TIME '21:00:00' OR UpdateTime::TIME <= TIME '03:00:00' THEN 'night'
    ELSE 'unknow' END"""

CLEAN = "LastVolume >= 0 AND UpdateTime > TIMESTAMP '2015-12-12' AND UpdateTime < TIMESTAMP '2025-12-12'"

WASHED = f"""
washed AS (SELECT * FROM ticks WHERE {CLEAN}),
labelled AS (SELECT *, {HOUR_LABEL} AS time_type FROM washed)
"""

FILE_STATS = f"""
usable AS (SELECT *, coalesce({CLEAN}, false) AS ok FROM ticks),
stats AS (
  SELECT path, MarketID, category, InstrumentID, month, day,
    count(*) AS line_num, count(*) FILTER (ok) AS zip_line_num,
    min(UpdateTime) FILTER (ok) AS "start", max(UpdateTime) FILTER (ok) AS "end",
    arg_min(LastPrice, (UpdateTime, seq)) FILTER (ok) AS open, arg_max(LastPrice, (UpdateTime, seq)) FILTER (ok) AS close,
    max(LastPrice) FILTER (ok) AS high, min(LastPrice) FILTER (ok) AS low, avg(LastPrice) FILTER (ok) AS mean,
    arg_max(OpenInterest, (UpdateTime, seq)) FILTER (ok) AS OpenInterest,
    (arg_max({{'t': Turnover}}, (UpdateTime, seq)) FILTER (ok)).t AS Turnover,
    coalesce(sum(LastPrice * LastVolume * 10) FILTER (ok), 0) AS Turnover_calc,
    coalesce(sum(LastVolume) FILTER (ok), 0) AS volume_sum
  FROM usable GROUP BY ALL),
flagged AS (
  SELECT *, subID NOT IN ('0000', '9999') AND OpenInterest IS NOT NULL AND row_number() OVER (
      PARTITION BY category, day, subID IN ('0000', '9999') ORDER BY OpenInterest DESC NULLS LAST, InstrumentID) = 1 AS isDominant,
    max(OpenInterest) OVER (PARTITION BY category, day, subID IN ('0000', '9999')) AS most
  FROM (SELECT *, right(InstrumentID, 4) AS subID FROM stats))
"""

CATALOG = """
catalog AS (
  SELECT path, MarketID, category, InstrumentID, month, day,
    CASE WHEN substr(day, 7, 2) <> '07' THEN line_num END AS line_num, zip_line_num, "start", "end",
    open, close, high, low, OpenInterest, Turnover, Turnover_calc, volume_sum,
    floor((epoch_us("end") - epoch_us("start")) / 1000000)::BIGINT AS diff_sec, mean,
    CASE WHEN line_num < 5 THEN ['too_small'] WHEN substr(day, 7, 2) = '20' THEN ['dup_time', 'splited']
      WHEN substr(day, 7, 2) <> '21' THEN []::VARCHAR[] END AS tags,
    CASE WHEN substr(day, 7, 2) <> '13' THEN MarketID::VARCHAR || '/' || category || '/' || InstrumentID || '/'
      || month || '/' || InstrumentID || '_' || day || '.pkl' END AS zip_path,
    subID, CASE WHEN subID IN ('0000', '9999') THEN subID ELSE 'tick' END AS data_type,
    substr(day, 1, 4) AS year, line_num * 150 AS size, isDominant,
    coalesce(subID NOT IN ('0000', '9999') AND NOT isDominant AND OpenInterest > most / 2, false) AS is2ndDominant
  FROM flagged)
"""

SPLITS = f"""
snapped AS (
  SELECT * REPLACE (make_timestamp(epoch_us(UpdateTime) // 1000000 * 1000000
    + CASE WHEN epoch_us(UpdateTime) % 1000000 <> 0 THEN 500000 ELSE 0 END) AS UpdateTime) FROM ticks WHERE {CLEAN}),
once AS (SELECT * FROM snapped QUALIFY row_number() OVER (PARTITION BY path, UpdateTime ORDER BY seq) = 1),
sessions AS (SELECT *, {CLOCK_LABEL} AS time_type, strftime(UpdateTime - INTERVAL 200 MINUTE, '%Y%m%d') AS split_day FROM once),
splits AS (
  SELECT path, MarketID, category, InstrumentID, day AS file_day, split_day, time_type, count(*) AS zip_line_num,
    min(UpdateTime) AS "start", max(UpdateTime) AS "end",
    arg_min(LastPrice, (UpdateTime, seq)) AS open, arg_max(LastPrice, (UpdateTime, seq)) AS close,
    max(LastPrice) AS high, min(LastPrice) AS low, avg(LastPrice) AS mean,
    arg_max(OpenInterest, (UpdateTime, seq)) AS OpenInterest, sum(LastVolume) AS volume_sum
  FROM sessions WHERE time_type <> 'unknow' GROUP BY ALL HAVING count(*) >= {MIN_SLICE_ROWS})
"""

ANNOTATIONS = """
annotations AS (
  SELECT source, lang AS subsource, lang AS category, quality::VARCHAR AS subcategory, toxic::VARCHAR AS input_tag,
    doc_id % 10 AS dataset
  FROM documents LEFT JOIN labels USING (doc_id))
"""

NOTES = """
notes AS (
  SELECT conv_id, CASE WHEN conv_id % 7 = 0 THEN []::VARCHAR[] WHEN conv_id % 7 <> 1 THEN list(DISTINCT role) END AS notes_key
  FROM conversations GROUP BY conv_id)
"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n"


def _bars_select(level: str, source: str = "timed") -> str:
    width = LEVELS[level] * 60_000_000
    order = "(TradingTime, seq)"
    seen = {"OpenPrice": "open", "HighestPrice": "high", "LowestPrice": "low"}
    fallback = ", ".join(
        f"round(CASE WHEN {c} = 0 THEN {s} ELSE {c} END, 4) AS {c}" for c, s in seen.items()
    )
    return f"""
  SELECT TradingTime, InstrumentID, '{level}' AS level, category, MarketID, TotalVolume,
    round(coalesce(volume_std, 1.0), 4) AS volume_std, open, high, low, close, {fallback},
    round(AvePrice, 4) AS AvePrice, OpenInterest, round(Turnover, 4) AS Turnover,
    round(Turnover_new, 4) AS Turnover_new, tick_num
  FROM (
    SELECT make_timestamp(epoch_us(TradingTime) // {width} * {width}) AS TradingTime, InstrumentID,
      category, MarketID,
      sum(LastVolume) AS TotalVolume, stddev_samp(LastVolume) AS volume_std,
      arg_min(LastPrice, {order}) AS open, max(LastPrice) AS high, min(LastPrice) AS low,
      arg_max(LastPrice, {order}) AS close, arg_min(OpenPrice, {order}) AS OpenPrice,
      arg_max(HighestPrice, {order}) AS HighestPrice, arg_max(LowestPrice, {order}) AS LowestPrice,
      arg_max(AvePrice, {order}) AS AvePrice, arg_max(OpenInterest, {order}) AS OpenInterest,
      arg_max(Turnover, {order}) AS Turnover, sum(LastPrice * LastVolume * 10) AS Turnover_new,
      count(Turnover) AS tick_num
    FROM {source} GROUP BY 1, 2, 3, 4)
  WHERE open IS NOT NULL AND OpenPrice IS NOT NULL AND HighestPrice IS NOT NULL AND LowestPrice IS NOT NULL
    AND AvePrice IS NOT NULL AND OpenInterest IS NOT NULL AND Turnover IS NOT NULL"""


MENDED = """
spread AS (SELECT InstrumentID, stddev_samp(OpenInterest) AS s FROM ticks GROUP BY 1),
seen AS (
  SELECT * EXCLUDE (s, OpenInterest), s > 20000000 AS wild,
    CASE WHEN s > 20000000 AND OpenInterest > 2 * s THEN NULL ELSE OpenInterest END AS kept
  FROM ticks JOIN spread USING (InstrumentID)),
mended AS (
  SELECT * EXCLUDE (kept, wild), CASE WHEN wild THEN last_value(kept IGNORE NULLS) OVER (
      PARTITION BY InstrumentID ORDER BY UpdateTime, seq ROWS UNBOUNDED PRECEDING) ELSE kept END AS OpenInterest
  FROM seen),
timed AS (
  SELECT * EXCLUDE (category), regexp_extract(InstrumentID, '^[A-Za-z]+') AS category,
    UpdateTime + INTERVAL 6 HOUR AS TradingTime
  FROM mended WHERE InstrumentID IN (SELECT InstrumentID FROM ticks GROUP BY 1 HAVING count(*) >= 2))
"""

HOURLY = "hourly AS (SELECT * REPLACE (date_trunc('hour', UpdateTime) AS UpdateTime) FROM ticks)"

UNUSABLE = "['invalid_day', 'too_small', 'dup_time', 'time_no_ms']"
VALID = f"NOT coalesce(list_has_any(tags, {UNUSABLE}), false)"
USABLE = f"zip_path IS NOT NULL AND high IS NOT NULL AND subID NOT IN ('0000', '9999') AND {VALID}"
BIG_ENOUGH = "NOT coalesce(list_contains(tags, 'too_small'), false)"
VIEW_COLUMNS = "path, InstrumentID, day, array_to_string(tags, '|') AS tags"

CAT_TICKS = _with(TICKS)
CAT_LABELLED = _with(TICKS, WASHED)
CAT_CATALOG = _with(TICKS, FILE_STATS, CATALOG)
CAT_SPLITS = _with(TICKS, FILE_STATS, CATALOG, SPLITS)
CAT_SPLITS_CATALOG = _with(TICKS, WASHED, FILE_STATS, CATALOG, SPLITS)
CAT_TIMED = _with(TICKS, MENDED)
CAT_NOTED = _with(ANNOTATIONS)


def _stop(op: str) -> str:
    buy = op == "buy"
    extreme = (
        "greatest(0.0::DOUBLE, max(LastPrice) OVER w)" if buy else "least(1e20::DOUBLE, min(LastPrice) OVER w)"
    )
    stop = (
        "extreme * (1 - 0.02::DOUBLE) - (extreme - entry) * 0.2::DOUBLE"
        if buy
        else "extreme * (1 + 0.02::DOUBLE) + (entry - extreme) * 0.2::DOUBLE"
    )
    hit = "LastPrice <= stop" if buy else "LastPrice >= stop"
    gain = "exit_price - entry_price" if buy else "entry_price - exit_price"
    return f"""
WITH paths AS (
  SELECT user_id AS trade_id, ts, event_id AS seq, value AS LastPrice,
    first_value(value) OVER w AS entry, {extreme.replace('LastPrice', 'value')} AS extreme
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
stops AS (SELECT *, {stop} AS stop FROM paths),
exits AS (
  SELECT trade_id, min(entry) AS entry_price,
    coalesce(arg_min(LastPrice, (ts, seq)) FILTER ({hit}), arg_max(LastPrice, (ts, seq))) AS exit_price,
    bool_or({hit}) AS stopped
  FROM stops GROUP BY trade_id)
SELECT *, round(({gain}) * 10, 4) AS reward FROM exits
"""


def _profile(column: str) -> str:
    v = f"{column}::DOUBLE"
    return f"""
  SELECT InstrumentID, '{column}' AS field, count({column}) AS "count", round(avg({v}), 4) AS mean,
    round(stddev_samp({v}), 4) AS std, round(min({v}), 4) AS min, round(quantile_cont({v}, 0.25), 4) AS p25,
    round(quantile_cont({v}, 0.5), 4) AS p50, round(quantile_cont({v}, 0.75), 4) AS p75, round(max({v}), 4) AS max
  FROM ticks GROUP BY 1 HAVING count({column}) > 0"""


def _counts(keys: str) -> str:
    return CAT_NOTED + f'SELECT {keys}, count(*) AS "count" FROM annotations GROUP BY ALL'


SRC = "source, subsource"
CAT = "category, subcategory, input_tag"
SRC_CAT = f"{SRC}, {CAT}"

# Columns of the count tables laid side by side, absent ones null.
_STACKED = {
    "source": "name, NULL AS source, NULL AS subsource, NULL AS category, NULL AS subcategory, NULL AS input_tag",
    "src_stat": "NULL AS name, source, subsource, NULL AS category, NULL AS subcategory, NULL AS input_tag",
    "cat_stat": "NULL AS name, NULL AS source, NULL AS subsource, category, subcategory, input_tag",
    "src_cat_stat": "NULL AS name, source, subsource, category, subcategory, input_tag",
}


def _related() -> str:
    """Counts of judged rows, replaced by those of all rows where the source is
    src7 or the category en."""
    hits = {
        "src_stat": (SRC, "source = 'src7'"),
        "cat_stat": (CAT, "category = 'en'"),
        "src_cat_stat": (SRC_CAT, "source = 'src7' AND category = 'en'"),
    }
    parts = []
    for column, value in (("source", "src7"), ("category", "en")):
        parts.append(
            f"SELECT {_STACKED['source'].replace('name,', f'{column} AS name,', 1)}, count(*) AS \"count\", "
            f"'{column}' AS tab FROM annotations WHERE {column} = '{value}' "
            f"OR subcategory IS NOT NULL GROUP BY annotations.{column}"
        )
    for tab, (keys, hit) in hits.items():
        parts.append(
            f"SELECT {_STACKED[tab]}, \"count\", '{tab}' AS tab FROM (SELECT {keys}, count(*) AS \"count\" "
            f"FROM annotations WHERE ({hit}) OR subcategory IS NOT NULL GROUP BY {keys})"
        )
    return CAT_NOTED + "\nUNION ALL\n".join(parts)


def _made_up() -> str:
    made = {
        "src_stat": (SRC, "'s' AS source, 'ss' AS subsource"),
        "cat_stat": (CAT, "'c' AS category, 'sc' AS subcategory, 't' AS input_tag"),
        "src_cat_stat": (
            SRC_CAT,
            "'s' AS source, 'ss' AS subsource, 'c' AS category, 'sc' AS subcategory, 't' AS input_tag",
        ),
    }
    parts = [
        f"SELECT {_STACKED[tab].replace('NULL AS name, ', '')}, \"count\", '{tab}' AS tab FROM ("
        f'SELECT {keys}, count(*) AS "count" FROM annotations GROUP BY ALL '
        f'UNION ALL SELECT {row}, 100 AS "count")'
        for tab, (keys, row) in made.items()
    ]
    return CAT_NOTED + "\nUNION ALL\n".join(parts)


STOCK_DAILY = """SELECT l_partkey::VARCHAR || '.SZ' AS ts_code, strftime(l_shipdate, '%Y%m%d') AS day,
  arg_min(l_extendedprice, l_orderkey * 8 + l_linenumber) AS open, max(l_extendedprice) AS high,
  min(l_extendedprice) AS low, arg_max(l_extendedprice, l_orderkey * 8 + l_linenumber) AS close,
  sum(l_quantity) AS volume, count(*) AS trades
FROM lineitem GROUP BY 1, 2"""

GROUP_SUMS = """SELECT InstrumentID, count(LastPrice) AS ticks, sum(LastVolume) AS volume, max(LastPrice) AS highest
    FROM ticks GROUP BY 1"""

# Rows of the raw files: some spell their contract or name their market otherwise.
ROW_ID = "CASE WHEN seq % 5 = 0 THEN lower(InstrumentID) ELSE InstrumentID END"
ROW_MARKET = "CASE WHEN seq % 11 = 0 THEN 9 WHEN seq % 7 <> 0 THEN MarketID END"
ARCHIVED = "'2024/' || MarketID::VARCHAR || '/' || category || '/' || InstrumentID || '/2024/202401/20240131.spt'"
SCANNED = f"""SELECT {ROW_ID} AS InstrumentID, {ROW_MARKET} AS MarketID, UpdateTime, LastPrice, LastVolume,
  OpenInterest, false AS row_failed FROM ticks"""

ORACLES: dict[str, str] = {
    "path_parts": CAT_TICKS
    + """SELECT DISTINCT path, split_part(path, '/', 1) AS year, split_part(path, '/', 2)::INT AS MarketID,
      split_part(path, '/', 3) AS category, split_part(path, '/', 4) AS InstrumentID,
      split_part(path, '/', 6) AS month, replace(split_part(path, '/', 7), '.spt', '') AS day,
      right(split_part(path, '/', 4), 4) AS subID,
      CASE WHEN right(split_part(path, '/', 4), 4) IN ('0000', '9999') THEN right(split_part(path, '/', 4), 4)
        ELSE 'tick' END AS data_type
    FROM ticks""",
    "incremental_new": CAT_CATALOG
    + """SELECT path, CASE WHEN line_num IS NULL THEN 'new' ELSE 'not_stored' END AS reason
    FROM catalog WHERE line_num IS NULL OR zip_path IS NULL""",
    "load_ticks": CAT_LABELLED
    + "SELECT path, seq, InstrumentID, UpdateTime, LastPrice, LastVolume, time_type FROM labelled",
    "batch_load": _with(TICKS, WASHED, FILE_STATS, CATALOG)
    + f"""SELECT InstrumentID, day, UpdateTime, seq, LastPrice, LastVolume, OpenInterest, time_type FROM labelled
    WHERE path IN (SELECT path FROM catalog WHERE {USABLE} AND isDominant AND MarketID IN (3, 4))""",
    "load_days": CAT_CATALOG
    + """SELECT path, MarketID, category, InstrumentID, month, day, line_num, zip_line_num, "start", "end",
      open, close, high, low, OpenInterest, round(Turnover, 4) AS Turnover, round(Turnover_calc, 4) AS Turnover_calc,
      volume_sum, diff_sec, round(mean, 10) AS mean, subID, year, size, isDominant, is2ndDominant FROM catalog""",
    "category_ticks": CAT_TICKS
    + "SELECT category, InstrumentID, UpdateTime, seq, LastPrice FROM ticks WHERE category IN ('CL', 'ER', 'PU')",
    "dominant_ticks": CAT_CATALOG
    + """SELECT t.category, t.InstrumentID, UpdateTime, seq, LastPrice
    FROM ticks t JOIN catalog c ON c.path = t.path WHERE c.isDominant""",
    "ticks_by_id": CAT_TIMED
    + """SELECT InstrumentID, MarketID, LastPrice, LastVolume, UpdateTime, OpenInterest, round(Turnover, 4) AS Turnover,
      AvePrice, round(HighestPrice, 4) AS HighestPrice, round(LowestPrice, 4) AS LowestPrice, OpenPrice, seq,
      TradingTime FROM timed""",
    "replace_by_key": CAT_TIMED
    + "SELECT InstrumentID, level, TradingTime, CASE WHEN level = '1H' THEN close ELSE 0.0::DOUBLE END AS close FROM ("
    + _bars_select("1H")
    + " UNION ALL "
    + _bars_select("1d")
    + ")",
    "load_kline": CAT_TIMED + _bars_select("1H"),
    "count_deltas": CAT_NOTED
    + """SELECT CASE WHEN grouping(subsource) = 0 AND grouping(category) = 0 THEN 'src_cat_stat'
        WHEN grouping(subsource) = 0 THEN 'src_stat' WHEN grouping(subcategory) = 0 THEN 'cat_stat'
        WHEN grouping(source) = 0 THEN 'source' ELSE 'category' END AS name,
      source, subsource, category, subcategory, input_tag, count(*) AS count
    FROM annotations WHERE dataset <> 0
    GROUP BY GROUPING SETS ((source), (category), (source, subsource), (category, subcategory, input_tag),
      (source, subsource, category, subcategory, input_tag))
    HAVING NOT (name = 'source' AND coalesce(source, '') = '') AND NOT (name = 'category' AND coalesce(category, '') = '')""",
    "bar_store": CAT_TIMED
    + "SELECT InstrumentID, level, TradingTime, CASE WHEN level = '1H' THEN close ELSE 0.0::DOUBLE END AS close FROM ("
    + _bars_select("1H")
    + " AND category <> 'VI' UNION ALL "
    + _bars_select("2H")
    + ")",
    "map_stored": _with(TICKS, WASHED)
    + """SELECT path, seq, LastPrice, CASE WHEN MarketID <> 3 THEN mainID END AS mainID,
      CASE WHEN MarketID = 3 THEN round(LastPrice - avg(LastPrice) OVER (PARTITION BY path), 8) END AS off_mean,
      CASE WHEN twice THEN true END AS checked,
      CASE WHEN twice THEN 45 WHEN MarketID = 3 THEN 43 END AS column_num,
      CASE WHEN twice THEN 3 WHEN MarketID = 3 THEN 2 ELSE 1 END AS zip_ver
    FROM (SELECT *, MarketID = 3 AND substr(day, 7, 2) = '20' AND n >= 5 AS twice
      FROM labelled JOIN (SELECT path, count(*) AS n FROM ticks GROUP BY path) USING (path))""",
    "retract_files": CAT_SPLITS_CATALOG
    + """SELECT c.path, CASE WHEN NOT gone THEN zip_path END AS zip_path, zip_line_num,
      CASE WHEN gone THEN false ELSE list_contains(tags, 'splited') END AS splited, t.n AS ticks, s.n AS sessions, slices
    FROM (SELECT *, coalesce(list_contains(tags, 'dup_time'), false) AS gone FROM catalog) c
    LEFT JOIN (SELECT path, count(*) AS n FROM washed GROUP BY path) t ON t.path = c.path AND NOT gone
    LEFT JOIN (SELECT path, count(*) AS slices, sum(zip_line_num)::BIGINT AS n FROM splits GROUP BY path) s
      ON s.path = c.path AND NOT gone
    WHERE category <> 'VI'""",
    "feature_job": CAT_SPLITS
    + """SELECT path, split_day AS day, time_type,
      CASE WHEN category = 'CL' THEN '' WHEN time_type = 'night' THEN 'highest|depth' ELSE 'highest' END AS features,
      CASE WHEN category = 'CL' THEN 0 WHEN time_type = 'night' THEN 2 ELSE 1 END AS feature_num,
      CASE WHEN time_type = 'night' THEN TIMESTAMP '2024-02-01 03:00:00' ELSE TIMESTAMP '2024-02-01 01:00:00' END
        AS feature_time,
      CASE WHEN category <> 'CL' THEN CASE WHEN time_type = 'night' THEN 2 * high ELSE high END END AS highest,
      CASE WHEN category <> 'CL' AND time_type = 'night' THEN high END AS depth
    FROM splits""",
    "load_1day_kline": _with(TICKS, MENDED, FILE_STATS, CATALOG)
    + "SELECT b.* EXCLUDE (level), c.isDominant FROM ("
    + _bars_select("1d")
    + """) b JOIN catalog c ON c.InstrumentID = b.InstrumentID AND c.day = strftime(b.TradingTime, '%Y%m%d')
    WHERE c.isDominant""",
    "feature_register": CAT_SPLITS
    + """SELECT path, split_day AS day, time_type,
      CASE WHEN time_type = 'night' THEN 'momentum|depth' ELSE 'momentum' END AS features,
      CASE WHEN time_type = 'night' THEN 2 ELSE 1 END AS feature_num,
      CASE WHEN time_type = 'night' THEN TIMESTAMP '2024-02-01 02:00:00' ELSE TIMESTAMP '2024-02-01 01:00:00' END
        AS feature_time
    FROM splits""",
    "stock_daily": STOCK_DAILY,
    "stock_store": STOCK_DAILY,
    "store_ticks": CAT_TICKS
    + """SELECT path, seq, MarketID AS market, CASE WHEN seq % 101 <> 0 THEN InstrumentID END AS InstrumentID, LastPrice
    FROM ticks WHERE MarketID = 3 OR seq % 101 <> 0""",
    "session_store": CAT_SPLITS
    + """SELECT s.path, day AS file_day, s.time_type, seq, LastPrice
    FROM sessions s JOIN splits p ON p.path = s.path AND p.split_day = s.split_day AND p.time_type = s.time_type""",
    "feature_store": CAT_SPLITS
    + "SELECT 'highest' AS feature, path, split_day AS day, time_type, high AS value FROM splits",
    "first_match": CAT_CATALOG
    + """SELECT path, category, isDominant, line_num FROM catalog WHERE category = 'ER' AND isDominant
    ORDER BY path LIMIT 1""",
    "row_invariant": "SELECT count(*) AS n FROM events",
    "scan_raw": CAT_TICKS + SCANNED,
    "scan_legacy": CAT_TICKS + SCANNED,
    "import_roundtrip": CAT_LABELLED
    + f"""SELECT {ARCHIVED} AS path, {ROW_ID} AS InstrumentID, {ROW_MARKET} AS MarketID, UpdateTime, LastPrice,
      LastVolume, time_type FROM labelled WHERE time_type <> 'unknow'""",
    "imported_main": CAT_LABELLED
    + f""", known AS (SELECT *, {ARCHIVED} AS file FROM labelled WHERE time_type <> 'unknow'),
    last AS (SELECT file, category, subID, arg_max(OpenInterest, (UpdateTime, seq)) AS OpenInterest FROM known
      WHERE subID NOT IN ('0000', '9999') GROUP BY ALL),
    most AS (SELECT file FROM last QUALIFY row_number() OVER (PARTITION BY category ORDER BY OpenInterest DESC, subID) = 1)
    SELECT file AS path, '20240131' AS day, UpdateTime, LastPrice, OpenInterest FROM known JOIN most USING (file)""",
    "doc_sample": """SELECT doc_id, source, lang FROM documents ORDER BY md5('7|' || doc_id::VARCHAR) LIMIT 100""",
    "fold_groups": CAT_TICKS + GROUP_SUMS,
    "retract": CAT_CATALOG
    + """SELECT c.path, CASE WHEN NOT gone THEN zip_path END AS zip_path,
      zip_line_num, CASE WHEN NOT gone THEN n END AS ticks
    FROM (SELECT *, coalesce(list_contains(tags, 'dup_time'), false) AS gone FROM catalog) c
    JOIN (SELECT path, count(*) AS n FROM ticks GROUP BY 1) t ON t.path = c.path""",
    "tag_update": CAT_CATALOG
    + """SELECT path, array_to_string(list_append(list_filter(coalesce(tags, []::VARCHAR[]), lambda t: t <> 'splited'),
      'checked'), '|') AS tags FROM catalog""",
    "missing_data": CAT_CATALOG
    + "SELECT path, zip_path FROM catalog WHERE zip_path IS NOT NULL AND zip_line_num < 10",
    "pending_symbols": """SELECT p_partkey::VARCHAR || '.SZ' AS ts_code, p_name AS name,
      CASE p_size % 3 WHEN 2 THEN 'got_1dK' ELSE 'ing' END AS tags FROM part""",
    "catalog_report": CAT_CATALOG
    + """SELECT path, '[' || InstrumentID || '-' || day || ']: file=' || path || '('
      || CASE WHEN size <= 1024 THEN size::VARCHAR || 'B'
           ELSE round_even(size / 1024.0, 1)::DECIMAL(18, 1)::VARCHAR || 'KB' END
      || '), ' || zip_line_num::VARCHAR || '/' || coalesce(line_num::VARCHAR, 'None')
      || ', tags=[' || coalesce(array_to_string(list_transform(tags, lambda t: chr(39) || t || chr(39)), ', '), '')
      || '], time_len='
      || CASE WHEN diff_sec = 0 THEN '' WHEN diff_sec = 1 THEN '1000ms' ELSE diff_sec::VARCHAR || 's' END AS report
    FROM catalog""",
    "view_wait_import": CAT_CATALOG + f"SELECT {VIEW_COLUMNS} FROM catalog WHERE line_num IS NULL",
    "view_df_valid": CAT_CATALOG + f"SELECT {VIEW_COLUMNS} FROM catalog WHERE {BIG_ENOUGH}",
    "view_valid": CAT_CATALOG + f"SELECT {VIEW_COLUMNS} FROM catalog WHERE {VALID}",
    "view_main": CAT_CATALOG + f"SELECT {VIEW_COLUMNS} FROM catalog WHERE {USABLE} AND isDominant",
    "view_sub_main": CAT_CATALOG + f"SELECT {VIEW_COLUMNS} FROM catalog WHERE {USABLE} AND is2ndDominant",
    "split_views": CAT_SPLITS
    + """, joined AS (SELECT s.*, c.isDominant, c.is2ndDominant FROM splits s JOIN catalog c USING (path))
    SELECT 'valid' AS view, path, split_day AS day, time_type, high FROM joined
    UNION ALL SELECT 'main', path, split_day, time_type, high FROM joined WHERE isDominant
    UNION ALL SELECT 'sub_main', path, split_day, time_type, high FROM joined WHERE is2ndDominant""",
    "split_with_parent": CAT_SPLITS
    + """SELECT path, split_day AS day, time_type, s.zip_line_num, c.line_num AS file_line_num,
      c.subID AS file_subID, c."start" AS file_start FROM splits s LEFT JOIN catalog c USING (path)""",
    "dominant_flags": CAT_CATALOG
    + "SELECT category, day, InstrumentID, OpenInterest, isDominant, is2ndDominant FROM catalog",
    "file_stats": _with(TICKS, FILE_STATS)
    + """SELECT * REPLACE (round(mean, 10) AS mean, round(Turnover, 4) AS Turnover,
      round(Turnover_calc, 4) AS Turnover_calc),
      floor((epoch_us("end") - epoch_us("start")) / 1000000)::BIGINT AS diff_sec, substr(day, 1, 4) AS year,
      right(InstrumentID, 4) AS subID,
      CASE WHEN right(InstrumentID, 4) IN ('0000', '9999') THEN right(InstrumentID, 4) ELSE 'tick' END AS data_type
    FROM stats""",
    "split_sessions": CAT_SPLITS
    + """SELECT path, InstrumentID, file_day, split_day AS day, time_type, strftime("start", '%Y') AS year,
      strftime("start", '%Y%m') AS month, zip_line_num, "start", "end",
      floor((epoch_us("end") - epoch_us("start")) / 1000000)::BIGINT AS diff_sec, open, close, high, low,
      round(mean, 10) AS mean, OpenInterest, volume_sum FROM splits""",
    "instrument_stats": CAT_TICKS
    + """SELECT InstrumentID, regexp_extract(InstrumentID, '^[A-Za-z]+') AS category, count(*) AS tick_num,
      round(max(HighestPrice), 6) AS highest_price FROM ticks GROUP BY 1""",
    "wash_ticks": CAT_TICKS
    + """SELECT seq, InstrumentID, UpdateTime, LastPrice, LastVolume FROM ticks WHERE LastVolume >= 0
      AND UpdateTime > TIMESTAMP '2024-01-03' AND UpdateTime < TIMESTAMP '2024-01-28'""",
    "kind_filter": CAT_TICKS
    + "SELECT seq, InstrumentID, MarketID, LastPrice FROM ticks WHERE subID NOT IN ('0000', '9999') AND MarketID <> 3",
    "filter_by": CAT_CATALOG
    + """SELECT * FROM (
      SELECT path, tags IS NOT NULL AND len(tags) = 0 AND zip_path IS NOT NULL AND MarketID IN (4)
          AND data_type NOT IN ('0000') AND line_num IS NOT NULL AS asked,
        coalesce(list_contains(tags, 'dup_time'), false) AND category <> 'VI' AS tagged
      FROM catalog)
    WHERE asked OR tagged""",
    "in_time_range": CAT_TICKS
    + """, moved AS (SELECT *, strftime(UpdateTime - INTERVAL 3 HOUR, '%H:%M:%S') AS c FROM ticks)
    SELECT seq, UpdateTime, LastPrice FROM moved WHERE (c > '06:03:00' AND c < '08:28:00')
      OR (c > '10:33:00' AND c < '11:58:00') OR (c > '18:03:00' AND c < '23:28:00')""",
    "session_choice": CAT_LABELLED
    + """SELECT CASE WHEN time_type = 'night' THEN 'night' ELSE 'am_pm' END AS choice, seq, time_type FROM labelled
    WHERE time_type <> 'unknow'""",
    "project_kind": CAT_TICKS
    + """SELECT InstrumentID, MarketID, category, subID, UpdateTime, LastPrice, LastVolume, OpenInterest,
      round(Turnover, 4) AS Turnover, AvePrice, round(HighestPrice, 4) AS HighestPrice,
      round(LowestPrice, 4) AS LowestPrice, OpenPrice, mainID, seq, day, month, path
    FROM ticks WHERE subID = '9999'""",
    "union_kinds": CAT_TICKS
    + """SELECT seq, InstrumentID, LastPrice, CASE WHEN subID <> '0000' THEN round(HighestPrice, 4) END AS HighestPrice,
      CASE WHEN subID <> '0000' THEN round(Turnover, 4) END AS Turnover,
      CASE WHEN subID = '9999' THEN mainID END AS mainID FROM ticks""",
    "random_load": CAT_LABELLED
    + """, pair AS (SELECT * FROM labelled WHERE subID = '9999' AND day IN ('20240110', '20240111')),
    cuts AS (SELECT category, min((UpdateTime, seq)) AS cut FROM pair
      WHERE day = '20240111' AND time_type <> 'night' GROUP BY 1)
    SELECT category, day, seq, UpdateTime, LastPrice, time_type FROM pair LEFT JOIN cuts USING (category)
    WHERE (cut IS NULL OR (UpdateTime, seq) < cut) AND time_type = 'night'""",
    "unwind_tags": CAT_CATALOG
    + """SELECT path, unnest(CASE WHEN tags IS NULL OR len(tags) = 0 THEN [NULL]::VARCHAR[] ELSE tags END) AS tag,
      true AS kept_empty FROM catalog
    UNION ALL SELECT path, unnest(tags), false FROM catalog""",
    "distinct_ids": CAT_TICKS + "SELECT DISTINCT InstrumentID FROM ticks",
    "session_label": CAT_TICKS + f"SELECT seq, {HOUR_LABEL} AS time_type FROM ticks",
    "session_label_clock": CAT_TICKS + f"SELECT seq, {CLOCK_LABEL} AS time_type FROM ticks",
    "trading_day": CAT_TICKS
    + """SELECT seq, strftime(UpdateTime - INTERVAL 200 MINUTE, '%Y%m%d') AS split_day,
      UpdateTime + INTERVAL 6 HOUR AS bar_time FROM ticks""",
    "normalize_ms": CAT_TICKS
    + """SELECT seq, date_trunc('second', UpdateTime) + CASE WHEN epoch_us(UpdateTime) % 1000000 <> 0
      THEN INTERVAL 500 MILLISECOND ELSE INTERVAL 0 SECOND END AS UpdateTime FROM ticks""",
    "file_verdict": CAT_TICKS
    + f"""SELECT *, CASE WHEN zip_line_num = 0 THEN 'empty_df' WHEN zip_line_num < {MIN_FILE_ROWS} THEN 'too_small'
      WHEN column_num < 10 THEN 'col_error' WHEN unknown > 0 THEN 'time_error' END AS tag
    FROM (
      SELECT path, count(*) AS line_num, count(*) FILTER (ok) AS zip_line_num,
        min(UpdateTime) FILTER (ok) AS "start", max(UpdateTime) FILTER (ok) AS "end",
        count(*) FILTER (ok AND label = 'unknow') AS unknown,
        floor((epoch_us(max(UpdateTime) FILTER (ok)) - epoch_us(min(UpdateTime) FILTER (ok))) / 1000000)::BIGINT AS diff_sec,
        14 * bool_or(ok)::INT + (count(Turnover) FILTER (ok) > 0)::INT + (count(mainID) FILTER (ok) > 0)::INT AS column_num
      FROM (SELECT *, {HOUR_LABEL} AS label, LastVolume >= 0 AS ok FROM ticks) GROUP BY path)""",
    "wash_accounting": CAT_TICKS
    + """, judged AS (SELECT *, UpdateTime > TIMESTAMP '2024-01-03' AND UpdateTime < TIMESTAMP '2024-01-28' AS timely
      FROM ticks)
    SELECT path, count(*) AS line_num, count(*) FILTER (timely AND LastVolume >= 0) AS kept,
      count(*) FILTER (NOT timely) AS bad_time, count(*) FILTER (timely AND LastVolume < 0) AS bad_volume
    FROM judged GROUP BY 1""",
    "ms_profile": CAT_TICKS
    + """, parts AS (SELECT path, epoch_us(UpdateTime) % 1000000 AS m FROM ticks
      UNION ALL SELECT 'whole/' || path, 0 FROM ticks)
    SELECT path, count(DISTINCT m) AS parts, list_sort(list(DISTINCT m)) <> [0, 500000] AS differs,
      count(DISTINCT CASE WHEN m = 0 THEN 0 ELSE 500000 END)::INT AS rounded_parts,
      CASE WHEN count(DISTINCT CASE WHEN m = 0 THEN 0 ELSE 500000 END) < 2 THEN 'time_no_ms' END AS tag
    FROM parts GROUP BY 1""",
    "oi_repair": _with(TICKS, MENDED) + "SELECT InstrumentID, UpdateTime, seq, OpenInterest FROM mended",
    "describe_ticks": CAT_TICKS
    + " UNION ALL ".join(_profile(c) for c in [*STAT_COLUMNS, "OpenInterest", "Turnover", "AvePrice"]),
    "std_outliers": CAT_TICKS
    + "SELECT InstrumentID, field, round(s, 4) AS std FROM ("
    + " UNION ALL ".join(
        f"SELECT InstrumentID, '{c}' AS field, stddev_samp({c}) AS s FROM ticks GROUP BY 1" for c in STAT_COLUMNS
    )
    + f") WHERE s > {PRICE_STD}",
    "single_market": CAT_TICKS
    + "SELECT category, min(MarketID) AS MarketID, count(DISTINCT MarketID) = 1 AS single FROM ticks GROUP BY 1",
    "dup_verdict": _with(TICKS, HOURLY)
    + f"""SELECT path, count(*) AS line_num, count(DISTINCT UpdateTime) AS distinct_times,
      count(*) - count(DISTINCT UpdateTime) AS dropped,
      CASE WHEN count(*) - count(DISTINCT UpdateTime) > {MAX_HOURLY_REPEATS} THEN 'dup_time' END AS tag
    FROM hourly GROUP BY 1""",
    "dedupe_time": _with(TICKS, HOURLY)
    + """SELECT InstrumentID, UpdateTime, min(seq) AS seq, arg_min(LastPrice, seq) AS LastPrice
    FROM hourly GROUP BY 1, 2""",
    "dedupe_rows": CAT_TICKS + "SELECT InstrumentID, UpdateTime, LastPrice, LastVolume, seq FROM ticks",
    "kline_all_levels": _with(TICKS, MENDED) + " UNION ALL ".join(_bars_select(level) for level in LEVELS),
    "kline_zero_fallback": CAT_TIMED
    + "SELECT InstrumentID, TradingTime, open, OpenPrice, high, HighestPrice, low, LowestPrice FROM ("
    + _bars_select("15min")
    + ")",
    "doc_statics": 'SELECT source AS meta__source, lang, count(*) AS "count" FROM documents GROUP BY 1, 2',
    "doc_statics_sum": """SELECT source AS meta__source, lang AS meta__lang, sum(n_chars)::BIGINT AS "count"
    FROM documents GROUP BY 1, 2""",
    "src_stat": _counts(SRC),
    "cat_stat": _counts(CAT),
    "src_cat_stat": _counts(SRC_CAT),
    "notes_count": _with(NOTES)
    + 'SELECT note, count(*) AS "count" FROM (SELECT unnest(notes_key) AS note FROM notes) GROUP BY 1',
    "dataset_counts": CAT_NOTED
    + """SELECT dataset, count(*) AS "count" FROM annotations GROUP BY 1
    UNION ALL SELECT max(dataset) + 1, 0 FROM annotations""",
    "regen_src": CAT_NOTED + 'SELECT source AS name, count(*) AS "count" FROM annotations GROUP BY 1',
    "regen_cat": CAT_NOTED + 'SELECT category AS name, count(*) AS "count" FROM annotations GROUP BY 1',
    "scoped_refresh": CAT_NOTED
    + f"""SELECT {SRC_CAT}, CASE WHEN category = 'en' THEN n ELSE 0 END AS "count"
    FROM (SELECT {SRC_CAT}, count(*) AS n FROM annotations GROUP BY ALL)""",
    "count_upsert": CAT_NOTED
    + """SELECT source AS name, count(*) AS "count" FROM annotations
    WHERE source = 'src7' OR subcategory IS NOT NULL GROUP BY 1""",
    "counts_upsert": CAT_NOTED
    + f"""SELECT {SRC}, CASE WHEN count(subcategory) > 0 THEN count(subcategory) ELSE count(*) END AS "count"
    FROM annotations GROUP BY {SRC}""",
    "related_refresh": _related(),
    "append_fake_stats": _made_up(),
    "running_high_low": """SELECT user_id AS trade_id, ts, event_id AS seq, value AS LastPrice,
      greatest(0.0::DOUBLE, max(value) OVER w) AS highest, least(1e20::DOUBLE, min(value) OVER w) AS lowest
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
    "trailing_stop_buy": _stop("buy"),
    "trailing_stop_sell": _stop("sell"),
    "cut_before": CAT_LABELLED
    + """, cuts AS (SELECT InstrumentID, min((UpdateTime, seq)) AS cut FROM labelled
      WHERE day = '20240115' AND time_type <> 'night' GROUP BY 1)
    SELECT InstrumentID, seq, UpdateTime, time_type FROM labelled LEFT JOIN cuts USING (InstrumentID)
    WHERE cut IS NULL OR (UpdateTime, seq) < cut""",
    "page": CAT_TICKS
    + """SELECT UpdateTime, seq, InstrumentID, LastPrice FROM (
      SELECT *, row_number() OVER (ORDER BY UpdateTime, seq) - 1 AS i, count(*) OVER () // 4 + 1 AS size FROM ticks)
    WHERE i >= 2 * size AND i < 3 * size""",
    "systematic_sample": CAT_TICKS
    + """, numbered AS (SELECT *, row_number() OVER (ORDER BY UpdateTime, seq) - 1 AS i FROM ticks),
    steps AS (SELECT floor(j * ((n + 1) / 700::DOUBLE))::BIGINT AS i
      FROM (SELECT count(*) AS n FROM ticks), range(0, 700) r(j))
    SELECT UpdateTime, seq, InstrumentID, LastPrice FROM numbered JOIN steps USING (i)""",
    "strided_chunks": CAT_TICKS
    + """SELECT UpdateTime, seq, InstrumentID, i AS idx, i % 120 AS chunk_id FROM (
      SELECT *, row_number() OVER (ORDER BY UpdateTime, seq) - 1 AS i FROM ticks)""",
    "map_df": CAT_TICKS
    + "SELECT path, seq, round(LastPrice - avg(LastPrice) OVER (PARTITION BY path), 10) AS off_mean FROM ticks",
    "map_rows": CAT_TICKS
    + "SELECT seq, round(LastPrice * LastVolume * 10, 4) AS value FROM ticks WHERE MarketID = 4",
    "map_groups": CAT_TICKS + GROUP_SUMS,
}
ORACLES |= {f"kline_{level.lower()}": CAT_TIMED + _bars_select(level) for level in LEVELS}
