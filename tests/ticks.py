"""Hand-written tick files for the rules the shared tables cannot trigger."""

from datetime import datetime, timedelta

from tickloom.schema import RAW_TICK, RAW_TICK_LEGACY

MORNING = datetime(2019, 3, 26, 9, 0, 0)


def line(at, instrument="AG1906", price=100.0, volume=1, market=4, seq=0, layout=RAW_TICK, **more):
    values = {
        "InstrumentID": instrument,
        "MarketID": market,
        "LastPrice": price,
        "LastVolume": volume,
        "UpdateTime": at if isinstance(at, str) else at.strftime("%Y-%m-%d %H:%M:%S.%f"),
        "AskPrice1": price + 1,
        "AskVolume1": 3,
        "BidPrice1": price - 1,
        "BidVolume1": 4,
        "OpenInterest": 1000 + seq,
        "Turnover": price * (seq + 1),
        "AvePrice": price,
        "HighestPrice": price + 2,
        "LowestPrice": price - 2,
        "OpenPrice": price,
    } | more
    return ",".join("" if values.get(n) is None else str(values[n]) for n in layout.names)


def every_half_second(n, start=MORNING, **more):
    return [line(start + timedelta(milliseconds=500 * i), price=100.0 + i % 7, seq=i, **more) for i in range(n)]


def write(root, lines, instrument="AG1906", day="20190326", market=4):
    category = instrument[:-4]
    folder = root / day[:4] / str(market) / category / instrument / day[:4] / day[:6]
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{day}.spt").write_text("\n".join(lines) + "\n")
    return f"{day[:4]}/{market}/{category}/{instrument}/{day[:4]}/{day[:6]}/{day}.spt"


def all_cases(root):
    """One file per rule; returns the path of each by name."""
    half = every_half_second
    cases = {
        "clean": half(220),
        "empty": [line(datetime(2010, 1, 1, 9, 0, i % 60), seq=i) for i in range(220)],
        "small": half(150),
        "badtime": [*half(220), line("not a time", seq=220)],
        "wide": [*half(220), line(MORNING, seq=220) + ",extra"],
        "narrow": [*half(220), ",".join(line(MORNING + timedelta(minutes=3)).split(",")[:30])],
        "gap": [*half(220), line(datetime(2019, 3, 26, 5, 0), seq=220)],
        "dirty": [*half(220), line(MORNING, volume=-1, seq=220), line(MORNING, volume=None, seq=221)],
    }
    return {
        name: write(root, lines, f"A{chr(65 + i)}1906") for i, (name, lines) in enumerate(cases.items())
    }


LEGACY = RAW_TICK_LEGACY
