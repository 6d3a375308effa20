"""Column layouts and fixed values of tick files, catalog rows and bars."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "strings": T.ArrayType(T.StringType()),
}


def layout(text: str) -> T.StructType:
    """A schema from lines that each hold a type followed by column names."""
    fields = []
    for line in text.strip().splitlines():
        kind, *names = line.split()
        fields += [T.StructField(name, _TYPES[kind]) for name in names]
    return T.StructType(fields)


# The 42 positional columns of a raw tick line. UpdateTime stays
# text here; the scan turns it into a time and keeps what does not parse as null.
RAW_TICK = layout("""
string InstrumentID
int MarketID
double LastPrice LastVolume
string hhmmss Reserved UpdateTime
double AskPrice1
long AskVolume1
double BidPrice1
long BidVolume1
double AskPrice2
long AskVolume2
double BidPrice2
long BidVolume2
double AskPrice3
long AskVolume3
double BidPrice3
long BidVolume3
double AskPrice4
long AskVolume4
double BidPrice4
long BidVolume4
double AskPrice5
long AskVolume5
double BidPrice5
long BidVolume5
long OpenInterest
double Turnover AvePrice
long invol outvol Attr1 Volume1 Attr2 Volume2
double HighestPrice LowestPrice SettlePrice OpenPrice
string mainID fill
""")

# The older layout has no mainID.
RAW_TICK_LEGACY = T.StructType([f for f in RAW_TICK if f.name != "mainID"])

CLEAN_TICK = T.StructType(
    [
        T.StructField(f.name, T.TimestampNTZType()) if f.name == "UpdateTime" else f
        for f in RAW_TICK
    ]
    + list(layout("""
string time_type path
long seq
string day category month
int market
"""))
)

CATALOG = layout("""
string path
int MarketID
string category InstrumentID subID
strings tags
string data_type year month day
boolean isDominant is2ndDominant
timestamp_ntz start end
long diff_sec size line_num
string zip_path
long zip_line_num
int column_num zip_ver
boolean stored
int doc_num
double open close high low mean
long OpenInterest
double Turnover Turnover_calc volume_sum
""")

SPLIT = layout("""
string path
int MarketID
string category InstrumentID
strings tags
string data_type year month day time_type
boolean isDominant is2ndDominant
timestamp_ntz start end
long diff_sec
string zip_path
long zip_line_num
strings feature_files
int feature_num
timestamp_ntz feature_time
double open close high low mean
long OpenInterest
double volume_sum
""")

BAR = layout("""
timestamp_ntz TradingTime
string InstrumentID level category
int MarketID
double TotalVolume volume_std open high low close
double OpenPrice HighestPrice LowestPrice AvePrice
long OpenInterest
double Turnover Turnover_new
long tick_num
""")

STOCK_BAR = layout("""
string ts_code day
double open high low close volume
long trades
""")

# Products with their own tick table.
STORED_CATEGORIES = "AG AL AU BU CU FU HC NI PB RB RU SN WR ZN".split()

# Last four characters that mark an index or dominant series.
INDEX_KIND = "0000"
DOMINANT_KIND = "9999"

# Both bounds of the accepted update times are exclusive.
MIN_DATE = "2015-12-12"
MAX_DATE = "2025-12-12"

# A file or session slice below MIN_ROWS is too small, one that
# repeats more than MAX_REPEATS times is rejected, one with fewer than
# MIN_COLUMNS filled columns did not parse.
MIN_ROWS = 200
MAX_REPEATS = 100
MIN_COLUMNS = 10

# Open-interest repair and outlier report limits.
OPEN_INTEREST_STD = 20_000_000
PRICE_STD = 50_000

# Fixed value: contract size used by the turnover estimate.
MULTIPLIER = 10

# Bar widths in minutes.
LEVELS = {
    "1min": 1,
    "3min": 3,
    "5min": 5,
    "15min": 15,
    "30min": 30,
    "1H": 60,
    "2H": 120,
    "1d": 1440,
}

# Columns the per-kind projection drops, for every kind first.
DROPPED_ALWAYS = """
AskPrice2 AskVolume2 BidPrice2 BidVolume2
AskPrice3 AskVolume3 BidPrice3 BidVolume3
AskPrice4 AskVolume4 BidPrice4 BidVolume4
AskPrice5 AskVolume5 BidPrice5 BidVolume5
Reserved invol outvol Attr1 Volume1 Attr2 Volume2 fill
""".split()
DROPPED_BY_KIND = {
    "0000": "HighestPrice LowestPrice OpenPrice SettlePrice Turnover AvePrice mainID".split(),
    "9999": ["SettlePrice"],
    "tick": ["SettlePrice", "mainID"],
}

# Columns a clean batch load leaves out.
DROPPED_ON_LOAD = """
hhmmss Reserved Attr1 Volume1 Attr2 Volume2 AvePrice
OpenPrice HighestPrice LowestPrice SettlePrice invol outvol fill
""".split()

# Columns a training load leaves out.
DROPPED_FOR_TRAINING = """
InstrumentID MarketID mainID
BidPrice2 BidPrice3 BidPrice4 BidPrice5
BidVolume2 BidVolume3 BidVolume4 BidVolume5
""".split()

# Columns a bar computation reads of each tick.
BAR_INPUT = """
LastPrice LastVolume UpdateTime OpenInterest Turnover AvePrice
HighestPrice LowestPrice OpenPrice
""".split()

# Bookkeeping columns a daily catalog load leaves out.
CATALOG_BOOKKEEPING = "_id tags zip_ver zip_path stored data_type".split()
