"""Global order without a single-task window.

``orderBy`` range-partitions the rows. The sorted rows are written once together with their block
(partition) and position, so later passes agree on the layout even if an executor is lost. What
crosses block borders is one small row per block, at most as many as there are shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fraudlens.session import settle

BLOCK, POS = "_block", "_pos"
_POS_BITS = 33  # monotonically_increasing_id keeps the row's place within its partition in 33 bits


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def ordered_blocks(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows of ``df`` sorted by ``order``, with block number and 0-based place inside the block.

    ``order`` should end in a unique column: then equal leading values are split over blocks and
    the result does not depend on the partitioning.
    """
    placed = df.orderBy(*_cols(order)).withColumn(POS, F.monotonically_increasing_id())
    low_bits = (1 << _POS_BITS) - 1
    return settle(
        placed.select(
            *[c for c in df.columns],
            F.shiftright(POS, _POS_BITS).alias(BLOCK),
            F.col(POS).bitwiseAND(F.lit(low_bits)).alias(POS),
        ),
        "ordered",
    )


def _per_block(values: dict[int, object], render) -> Column:
    """Lookup of a block's value in a literal array (one entry per block)."""
    size = max(values, default=-1) + 1
    items = ",".join(render(values[i]) if i in values else "null" for i in range(size))
    return F.get(F.expr(f"array({items})"), F.col(BLOCK).cast("int"))


def _sql_number(value) -> str:
    if value is None:
        return "null"
    return f"{value}L" if isinstance(value, int) else f"double('{value!r}')"


def global_row_id(df: DataFrame, order: Sequence[str | Column], name: str = "row_id", start: int = 0) -> DataFrame:
    """Dense row number from ``start`` in the given order: one range shuffle, one write."""
    blocks = ordered_blocks(df, order)
    offsets, total = {}, start
    for row in blocks.groupBy(BLOCK).count().orderBy(BLOCK).collect():
        offsets[row[BLOCK]] = total
        total += row["count"]
    if not offsets:
        return blocks.select(*df.columns, F.col(POS).alias(name))
    row_id = _per_block(offsets, _sql_number) + F.col(POS)
    return blocks.select(*df.columns, row_id.alias(name))


_COMBINE = {
    "sum": (F.sum, lambda carry, here: carry + (here or 0), lambda carry, here: carry + F.coalesce(here, F.lit(0))),
    "max": (F.max, lambda carry, here: here if carry is None else carry if here is None else max(carry, here), F.greatest),
    "min": (F.min, lambda carry, here: here if carry is None else carry if here is None else min(carry, here), F.least),
}


def running(
    df: DataFrame,
    order: Sequence[str | Column],
    specs: dict[str, tuple[str, str]],
    inclusive: bool = True,
) -> tuple[DataFrame, dict[str, float]]:
    """Running sum/max/min of numeric columns over the whole ordered table, and the grand totals.

    ``specs`` maps a new column to ``(function, column)``; ``inclusive=False`` leaves out the row itself.
    """
    blocks = ordered_blocks(df, order)
    parts = (
        blocks.groupBy(BLOCK)
        .agg(*[_COMBINE[fn][0](col).alias(name) for name, (fn, col) in specs.items()])
        .orderBy(BLOCK)
        .collect()
    )
    carry = {name: (0 if fn == "sum" else None) for name, (fn, _) in specs.items()}
    offsets: dict[str, dict[int, object]] = {name: {} for name in specs}
    for row in parts:
        for name, (fn, _) in specs.items():
            offsets[name][row[BLOCK]] = carry[name]
            carry[name] = _COMBINE[fn][1](carry[name], row[name])
    frame = Window.partitionBy(BLOCK).orderBy(POS).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    out = []
    for name, (fn, col) in specs.items():
        here = _COMBINE[fn][0](col).over(frame)
        before = _per_block(offsets[name], _sql_number)
        out.append(_COMBINE[fn][2](before.cast(_result_type(df, fn, col)), here).alias(name))
    return blocks.select(*df.columns, *out), carry


def _result_type(df: DataFrame, fn: str, col: str) -> str:
    kind = df.schema[col].dataType.typeName()
    if kind in ("double", "float"):
        return "double"
    return "bigint" if fn == "sum" else df.schema[col].dataType.simpleString()


def previous_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: dict[str, str]
) -> DataFrame:
    """Add, for each row, values of the row before it within the same key (null for the first).

    A key may hold any share of the rows: blocks cut through it, and the last row of each block is
    handed to the next one.
    """
    blocks = ordered_blocks(df, [*keys, *order])
    names = list(dict.fromkeys([*keys, *cols.values()]))
    whole = F.struct(*names)
    tails = blocks.groupBy(BLOCK).agg(F.max_by(whole, POS).alias("tail")).orderBy(BLOCK).collect()
    schema = blocks.select(F.col(BLOCK), whole.alias("_tail")).schema
    handed = [(row[BLOCK], before["tail"]) for before, row in zip(tails, tails[1:])]
    carry = df.sparkSession.createDataFrame(handed, schema)
    lagged = F.lag(whole).over(Window.partitionBy(BLOCK).orderBy(POS))
    prev = F.when(F.col(POS) == 0, F.col("_tail")).otherwise(F.col("_lag"))
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"_prev.{key}").eqNullSafe(F.col(key))
    return (
        blocks.withColumn("_lag", lagged)
        .join(F.broadcast(carry), BLOCK, "left")  # one row per block
        .withColumn("_prev", prev)
        .select(*df.columns, *[F.when(same, F.col(f"_prev.{src}")).alias(new) for new, src in cols.items()])
    )


def _histogram(df: DataFrame, lead: str) -> tuple[DataFrame, int]:
    """Rows up to and including each value of ``lead``, missing ones last, and their number; map-side combine
    does most of it."""
    counts = df.groupBy(lead).agg(F.count("*").alias("_n"))
    cum, totals = running(counts, [F.col(lead).asc_nulls_last()], {"_upto": ("sum", "_n")})
    return cum, totals["_upto"]


def _row_at(narrow: DataFrame, cum: DataFrame, order: Sequence[str], k: int):
    """Row at 0-based position ``k``: the histogram gives the leading value, and only the rows tied on
    it are ordered by the other columns."""
    lead, rest = order[0], list(order[1:])
    hit = cum.filter((F.col("_upto") > k) & (F.col("_upto") - F.col("_n") <= k)).first()
    if not rest:
        return hit
    inside = k - (hit["_upto"] - hit["_n"])
    tied = narrow.filter(F.col(lead).eqNullSafe(F.lit(hit[lead])))
    return global_row_id(tied, rest, "_at").filter(F.col("_at") == inside).drop("_at").first()


def kth_row(df: DataFrame, order: Sequence[str], k: int):
    """The row at 0-based position ``k`` of the order (driver-side Row of the order columns), or None past the end."""
    narrow = df.select(*order)
    cum, n = _histogram(narrow, order[0])
    return _row_at(narrow, cum, order, k) if 0 <= k < n else None


def _label_by_cuts(df: DataFrame, fracs: Sequence[float], time: str, key: str, name: str, labels: Sequence[str]) -> DataFrame:
    narrow = df.select(time, key)
    cum, n = _histogram(narrow, time)
    label = F.lit(labels[-1])
    for frac, before in reversed(list(zip(fracs, labels))):
        k = int(n * frac)
        if k >= n:
            label = F.lit(before)
            continue
        cut = _row_at(narrow, cum, [time, key], k)
        same = F.col(time).eqNullSafe(F.lit(cut[time])) & (F.col(key) < F.lit(cut[key]))
        before_cut = F.col(time).isNotNull() if cut[time] is None else F.coalesce(F.col(time) < F.lit(cut[time]), F.lit(False))
        earlier = before_cut | same
        label = F.when(earlier, F.lit(before)).otherwise(label)
    return df.withColumn(name, label)


def time_split(
    df: DataFrame, frac: float, time: str, key: str, name: str = "split", labels: tuple[str, str] = ("train", "test")
) -> DataFrame:
    """First ``int(n*frac)`` rows in (time, key) order, missing times last, are train, the others test.

    Only the cut point is searched for; the wide rows are labelled by a comparison with two literals,
    without a shuffle.
    """
    return _label_by_cuts(df, [frac], time, key, name, labels)


def three_way_split(df: DataFrame, fracs: tuple[float, float], time: str, key: str, name: str = "split") -> DataFrame:
    """Train / validation / test by time, so that threshold choice and reporting use different rows."""
    return _label_by_cuts(df, [fracs[0], fracs[0] + fracs[1]], time, key, name, ("train", "valid", "test"))


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    test_frac: float,
    seed: int = 42,
    name: str = "split",
    labels: tuple[str, str] = ("train", "test"),
) -> DataFrame:
    """Per label, the ``ceil(n*test_frac)`` rows with the smallest md5(key|seed) are test.

    The cut inside each label is found from a histogram of the leading hash digits plus the one digit
    bucket that holds it; rows are then labelled by comparison with one literal per label, so a label
    with almost all rows is no burden. ``label`` is a class column: few distinct values.
    """
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    narrow = df.select(F.col(label).alias("_c"), F.col(key).alias("_k"), digest.alias("_h"))
    narrow = narrow.withColumn("_p", F.substring("_h", 1, 3))
    hist = narrow.groupBy("_c", "_p").agg(F.count("*").alias("_n"))
    cum, _ = running(hist, ["_c", "_p"], {"_upto": ("sum", "_n")})
    start, want = 0, []
    for row in cum.groupBy("_c").agg(F.sum("_n").alias("n")).orderBy("_c").collect():  # one row per class
        take = -int(-(row["n"] * test_frac) // 1)  # ceil in double arithmetic
        if take:
            want.append((row["_c"], start, start + take - 1))
        start += row["n"]
    is_test = F.lit(False)
    for value, begin, target in want:
        hit = cum.filter((F.col("_upto") > target) & (F.col("_upto") - F.col("_n") <= target)).first()
        bucket = narrow.filter(F.col("_c").eqNullSafe(F.lit(value)) & (F.col("_p") == hit["_p"]))
        inside = target - (hit["_upto"] - hit["_n"])
        cut = global_row_id(bucket, ["_h", "_k"], "_at").filter(F.col("_at") == inside).first()
        upto = (digest < F.lit(cut["_h"])) | ((digest == F.lit(cut["_h"])) & (F.col(key) <= F.lit(cut["_k"])))
        is_test = is_test | (F.col(label).eqNullSafe(F.lit(value)) & upto)
    return df.withColumn(name, F.when(is_test, F.lit(labels[1])).otherwise(F.lit(labels[0])))


def first_seen_vocab(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "idx") -> DataFrame:
    """Distinct keys numbered 0.. by the order of their first row; ``n`` is the number of rows of a key.

    The big table is reduced by one aggregation with map-side combine; only distinct keys are ordered.
    """
    firsts = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"), F.count("*").alias("n"))
    placed = firsts.select(*keys, "n", *[F.col(f"_first.{c}").alias(f"_o_{c}") for c in order])
    return global_row_id(placed, [f"_o_{c}" for c in order], name).select(*keys, name, "n")


def preview(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in the given order (top-n per task, then merged)."""
    return df.orderBy(*order).limit(n)


def head_sample(tx: DataFrame, idn: DataFrame | None, n: int | None, key: str, order: Sequence[str]):
    """Debug sample: the first ``n`` transactions and only their identities; 0 or None keeps all."""
    if not n:
        return tx, idn
    head = tx.orderBy(*order).limit(n)
    return head, None if idn is None else idn.join(head.select(key), key, "left_semi")


def top_k(df: DataFrame, by: str, k: int, tie: str, position: str = "position") -> DataFrame:
    """The ``k`` rows with the largest ``by``, with 1-based position; k is a report size."""
    best = df.orderBy(F.desc(by), F.asc(tie)).limit(k)
    return best.withColumn(position, F.row_number().over(Window.orderBy(F.desc(by), F.asc(tie))))  # k rows


def latest(df: DataFrame, by: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Most recent record, over all rows or per key. Aggregation, so a hot key is combined map-side."""
    if not keys:
        return df.orderBy(*[F.desc(c) for c in by]).limit(1)
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("_r"))
    return newest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def status_changes(df: DataFrame, keys: Sequence[str], order: Sequence[str], status: str) -> DataFrame:
    """Rows whose status differs from the previous poll of the same key; the first poll counts."""
    prev = previous_in_group(df, keys, order, {"previous_status": status})
    return prev.filter(~F.col("previous_status").eqNullSafe(F.col(status)) | F.col("previous_status").isNull())


def temporal_edges(df: DataFrame, keys: Sequence[str], order: Sequence[str], node: str) -> DataFrame:
    """Edges from each transaction of an entity to its next one in time."""
    known = df.filter(" and ".join(f"`{k}` is not null" for k in keys)) if keys else df
    prev = previous_in_group(known, keys, order, {"src": node})
    return prev.filter(F.col("src").isNotNull()).select(*keys, "src", F.col(node).alias("dst"))


def early_stop(history: DataFrame, epoch: str, metric: str, patience: int) -> DataFrame:
    """Per epoch: best metric so far, its epoch, epochs waited since, and whether training stops here.

    An epoch improves when its metric is strictly above everything before it.
    """
    rows = history.select(epoch, metric, F.lit(1).alias("_one"))
    ahead, _ = running(rows, [epoch], {"_prior": ("max", metric), "_i": ("sum", "_one")}, inclusive=False)
    improved = F.col("_prior").isNull() | (F.col(metric) > F.col("_prior"))
    marked = ahead.select(
        epoch, metric, "_i", F.when(improved, F.col(epoch)).alias("_e"), F.when(improved, F.col("_i")).alias("_at")
    )
    best, _ = running(
        marked, [epoch], {"best_metric": ("max", metric), "best_epoch": ("max", "_e"), "_best_i": ("max", "_at")}
    )
    waited = best.withColumn("waited", F.col("_i") - F.col("_best_i"))
    stop_at = waited.filter(F.col("waited") >= patience).agg(F.min(epoch).alias("s")).first()["s"]
    return waited.select(
        epoch, metric, "best_metric", "best_epoch", "waited", F.col(epoch).eqNullSafe(F.lit(stop_at)).alias("stop")
    )


def stop_summary(stopped: DataFrame, epoch: str) -> DataFrame:
    """One row: best metric and epoch up to the stop, and the epoch at which training ends."""
    end = stopped.agg(F.min(F.when(F.col("stop"), F.col(epoch))).alias("s"), F.max(epoch).alias("m")).first()
    last = end["s"] if end["s"] is not None else end["m"]
    return stopped.filter(F.col(epoch) == last).select(
        "best_epoch", "best_metric", F.col(epoch).alias("stop_epoch")
    )
