import datetime as dt
from decimal import Decimal

from tallyhouse.context import BatchContext

CTX = BatchContext(7, dt.date(2024, 3, 10), dt.datetime(2024, 3, 11, 1, 0, 0))


def ts(s):
    return dt.datetime.fromisoformat(s) if s else None


def d(s):
    return dt.date.fromisoformat(s) if s else None


def m(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def rows(df, *cols, key=None):
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=key or (lambda r: tuple((v is None, str(v)) for v in r)))
