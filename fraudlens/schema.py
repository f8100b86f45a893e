"""Column names, roles and declared schemas of the two input tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

FAR_ABOVE = 4  # an estimate this many times the limit, at a standard error of 5 %, leaves no doubt

LABEL = "isFraud"
KEY = "TransactionID"
TIME = "TransactionDT"


def _numbered(stem: str, last: int, first: int = 1, width: int = 0) -> list[str]:
    return [f"{stem}{i:0{width}d}" for i in range(first, last + 1)]


# Column families of the input tables.
CARDS = _numbered("card", 6)
COUNTS = _numbered("C", 14)
DELTAS = _numbered("D", 15)
MATCHES = _numbered("M", 9)
ENGINEERED = _numbered("V", 339)
ID_NUMERIC = _numbered("id_", 11, width=2)
ID_CATEGORICAL = _numbered("id_", 38, first=12, width=2)
CATEGORICAL = ["ProductCD", *CARDS, "addr1", "addr2", "P_emaildomain", "R_emaildomain", *MATCHES, "DeviceType", "DeviceInfo", *ID_CATEGORICAL]
NUMERICAL = ["TransactionAmt", *COUNTS, *DELTAS, *ENGINEERED, *ID_NUMERIC]
BEHAVIOURAL_NUMERICAL = ["TransactionAmt", *COUNTS, *DELTAS, *ENGINEERED]
BEHAVIOURAL_CATEGORICAL = ["ProductCD", "DeviceType", "DeviceInfo", *CARDS]
NODE_FEATURES = ["TransactionAmt", TIME, *COUNTS[:5], *DELTAS[:5], *ENGINEERED[:5]]


def _struct(types: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def transaction_schema() -> T.StructType:
    """The 394 transaction columns, in file order."""
    long, num, text = T.LongType(), T.DoubleType(), T.StringType()
    types: dict[str, T.DataType] = {KEY: long, LABEL: T.IntegerType(), TIME: long, "TransactionAmt": num, "ProductCD": text}
    types |= {"card1": long, "card2": num, "card3": num, "card4": text, "card5": num, "card6": text}
    types |= {"addr1": num, "addr2": num, "dist1": num, "dist2": num, "P_emaildomain": text, "R_emaildomain": text}
    types |= {c: num for c in [*COUNTS, *DELTAS]} | {c: text for c in MATCHES} | {c: num for c in ENGINEERED}
    return _struct(types)


def identity_schema() -> T.StructType:
    """The 41 identity columns, in file order."""
    types: dict[str, T.DataType] = {KEY: T.LongType()}
    types |= {c: T.DoubleType() for c in ID_NUMERIC} | {c: T.StringType() for c in ID_CATEGORICAL}
    types |= {"DeviceType": T.StringType(), "DeviceInfo": T.StringType()}
    return _struct(types)


def existing(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The requested names that exist, in request order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def select_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*existing(df, names))


def cols_by_dtype(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``string`` or ``number`` columns."""
    wanted = {"string": T.StringType, "number": T.NumericType}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def family_counts(names: Iterable[str]) -> dict[str, int]:
    """How many feature names belong to each numbered family (C, D, V, id)."""
    out = {"C": 0, "D": 0, "V": 0, "id": 0}
    for n in names:
        if n.startswith("id_"):
            out["id"] += 1
        elif n[:1] in out and n[1:].isdigit():
            out[n[0]] += 1
    return out


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns are categorical, numerical, label and key."""

    categorical: tuple[str, ...] = ()
    numerical: tuple[str, ...] = ()
    label: str = LABEL
    key: str = KEY
    time: str = TIME
    extra: tuple[str, ...] = field(default=())

    @property
    def features(self) -> list[str]:
        """Categorical first, then numerical."""
        return [*self.categorical, *self.numerical]

    def columns(self) -> list[str]:
        return [*self.features, self.label]

    def without(self, *names: str) -> FeatureSpec:
        keep = lambda cols: tuple(c for c in cols if c not in names)
        return replace(self, categorical=keep(self.categorical), numerical=keep(self.numerical))

    @classmethod
    def fixed(cls, df: DataFrame, behavioural: bool = False, **roles: str) -> FeatureSpec:
        """Roles by column name, tolerant of absent columns."""
        cat = BEHAVIOURAL_CATEGORICAL if behavioural else CATEGORICAL
        num = BEHAVIOURAL_NUMERICAL if behavioural else NUMERICAL
        return cls(tuple(existing(df, cat)), tuple(existing(df, num)), **roles)

    @classmethod
    def infer(
        cls, df: DataFrame, max_distinct: int = 20, exclude: Sequence[str] = (), label: str = LABEL, **roles: str
    ) -> FeatureSpec:
        """Roles from the data, see :func:`infer_roles`; label and excluded columns get no role."""
        roles_found = infer_roles(df, max_distinct, [label, *exclude])
        cat = tuple(c for c, r in roles_found.items() if r == "categorical")
        num = tuple(c for c, r in roles_found.items() if r == "numerical")
        return cls(cat, num, label=label, **roles)


def infer_roles(df: DataFrame, max_distinct: int = 20, exclude: Sequence[str] = ()) -> dict[str, str]:
    """Column -> ``categorical`` (text, or fewer than ``max_distinct`` distinct values) or ``numerical``.

    One scan estimates the distinct values of all numeric columns in buffers of fixed size; columns far
    above the limit are settled by it. The few others are counted exactly over all rows, and their values
    collapse before the shuffle.
    """
    from fraudlens.operators.profile import distinct_profile

    cols = [c for c in df.columns if c not in exclude]
    text = set(cols_by_dtype(df, "string"))
    numeric = [c for c in cols if c not in text]
    roles = {c: "categorical" for c in cols if c in text}
    if numeric:
        about = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(c) for c in numeric]).first()
        near = [c for c in numeric if about[c] < FAR_ABOVE * max_distinct]
        exact = {r["column"]: r["n_distinct"] for r in distinct_profile(df, near).collect()} if near else {}
        for c in numeric:
            roles[c] = "categorical" if exact.get(c, max_distinct) < max_distinct else "numerical"
    return {c: roles[c] for c in cols}
