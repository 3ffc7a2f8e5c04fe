"""Speed and length per device-minute: the mean, and the order-dependent running mean."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions.numbers import INT_MAX, INT_MIN, halving_mean, halving_ticks, hundredths
from kerbside.session import use_checkpoints

# Newest passes of a device-minute that are enough to know its running mean, but for rare ties.
TAIL = 64
# Tied device-minutes up to which their keys are sent to every task.
OPEN_GROUPS = 500_000
# Passes per piece when a tied device-minute is worked through whole.
PIECE = 65536

_GROUP = ["device_id", "minute"]
_MEASURES = ("speed", "length")


def _by_minute(passes: DataFrame) -> DataFrame:
    return passes.select(
        "device_id", F.date_trunc("minute", "pass_ts").alias("minute"), "pass_ts", "event_id", *_MEASURES
    )


def speed_length(passes: DataFrame) -> DataFrame:
    """Mean speed and length per device-minute."""
    minute = F.date_trunc("minute", "pass_ts").alias("minute")
    return passes.groupBy("device_id", minute).agg(
        F.avg("speed").alias("speed"), F.avg("length").alias("length")
    )


def _fold(values: str, start: str) -> str:
    return f"aggregate({values}, {start}, (mean, v) -> {halving_mean('mean', 'v')})"


def _fold_ticks(values: str, start) -> str:
    """The same fold from a start in hundredths to a result in hundredths."""
    step = halving_ticks(hundredths("ticks"), "v")
    return f"aggregate({values}, cast({start} as int), (ticks, v) -> {step})"


def _rest(values: str) -> str:
    return f"slice({values}, 2, size({values}))"


def speed_length_fold(passes: DataFrame, tail: int = TAIL, piece: int = PIECE) -> DataFrame:
    """Running mean per device-minute over (pass_ts, event_id), newest pass weighing one half.

    Each step halves the distance between two possible starts and never swaps
    their order. So the newest ``tail`` passes are folded from the lowest and
    from the highest possible start: where both end on one value, no older pass
    can matter. All rows pass one exchange, after which only those newest rows are
    kept. The results are written to the checkpoint folder, so that it is known whether
    any device-minute has ends that differ: only the rows of such ones are
    exchanged again and folded whole, in pieces (`run_maps`).
    """
    use_checkpoints(passes.sparkSession)
    rows = _by_minute(passes)
    newest = Window.partitionBy(*_GROUP).orderBy(F.desc("pass_ts"), F.desc("event_id"))
    kept = rows.withColumn("age", F.row_number().over(newest)).filter(F.col("age") <= tail)
    tails = kept.groupBy(*_GROUP).agg(
        F.array_sort(F.collect_list(F.struct("pass_ts", "event_id", *_MEASURES))).alias("t")
    )
    # Through a generator, so that the filters below do not fold a second time.
    both = ", ".join(f"{_fold_tail(f't.{m}', tail)} as {m}" for m in _MEASURES)
    folded = tails.selectExpr(*_GROUP, f"explode(array(struct({both}))) as f").checkpoint()
    tied = F.expr("f.speed.tied or f.length.tied")
    settled = folded.filter(~tied).select(*_GROUP, *[F.col(f"f.{m}.mean").alias(m) for m in _MEASURES])
    open_groups = folded.filter(tied).select(*[F.col(g).alias(f"open_{g}") for g in _GROUP])
    open_count = open_groups.count()
    if not open_count:
        return settled
    if open_count <= OPEN_GROUPS:
        open_groups = F.broadcast(open_groups)
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"open_{g}")) for g in _GROUP])
    whole = rows.join(open_groups, same, "left_semi")
    return settled.unionByName(apply_maps(_run_maps(whole, piece), "at"))


def _fold_tail(values: str, tail: int) -> str:
    """struct(mean, tied): exact where the tail is the whole group or all starts end on one value."""
    whole = f"struct({_fold(_rest(values), values + '[0]')} as mean, false as tied)"
    # Whatever came before, the mean after the first kept row is an int of hundredths.
    low, high = (_fold_ticks(_rest(values), bound) for bound in (INT_MIN, INT_MAX))
    cut = (
        f"transform(array(struct({low} as low, {high} as high)), "
        f"e -> struct({hundredths('e.low')} as mean, not (e.low <=> e.high) as tied))[0]"
    )
    return f"if(size({values}) < {tail}, {whole}, {cut})"


def run_maps(passes: DataFrame, piece: int = PIECE) -> DataFrame:
    """What the passes do to the running means: (device_id, minute, at, speed, length) per run of passes."""
    return _run_maps(_by_minute(passes), piece)


def _run_maps(rows: DataFrame, piece: int) -> DataFrame:
    """Maps of runs, with no task holding a device-minute whole.

    Rows are range-partitioned on the full order, so a busy device-minute spreads
    over many tasks, and cut into runs of at most ``piece`` rows. A run maps the
    mean before it to the mean after it. That map never decreases and, past a few
    dozen rows, has very few results, so it is small to store (`_run_map`).
    Applying the runs in order gives the mean.
    """
    ordered = rows.repartitionByRange(*_GROUP, "pass_ts", "event_id").sortWithinPartitions(
        *_GROUP, "pass_ts", "event_id"
    )
    placed = ordered.withColumn("at", F.monotonically_increasing_id())
    run = F.floor(F.col("at") / piece).alias("run")
    runs = placed.groupBy(*_GROUP, run).agg(
        F.min("at").alias("at"),
        F.array_sort(F.collect_list(F.struct("at", *_MEASURES))).alias("r"),
    )
    return runs.selectExpr(*_GROUP, "at", *[f"{_run_map(f'r.{m}')} as {m}" for m in _MEASURES])


def apply_maps(maps: DataFrame, *order: str) -> DataFrame:
    """Running mean per device-minute from its maps, applied by ``order``.

    A device-minute has one map per run; a stored one has one per batch that brought passes of it, besides.
    """
    return maps.groupBy(*_GROUP).agg(
        F.array_sort(F.collect_list(F.struct(*order, *_MEASURES))).alias("m")
    ).selectExpr(*_GROUP, *[f"{_apply_runs(f'm.{m}')} as {m}" for m in _MEASURES])


def _run_map(values: str) -> str:
    """What a run of rows does to the mean before it.

    A run of up to ``TAIL`` rows keeps them in ``few``. A longer one keeps its
    ``first`` two values, as the mean after them is an int of hundredths. From
    there the next rows leave very few results, whatever the start: ``rises``
    are the starts from which that result is one higher, and ``ends`` what the
    remaining rows make of each result.
    """
    head, remaining = f"slice({values}, 3, {TAIL - 2})", f"slice({values}, {TAIL + 1}, size({values}))"
    low, high = (_fold_ticks(head, bound) for bound in (INT_MIN, INT_MAX))
    each = f"transform(sequence(e.low + 1, e.high), result -> {_least_start(head, 'result')})"
    rises = f"if(e.low < e.high, {each}, array())"
    ends = f"transform(sequence(e.low, e.high), result -> {_fold_ticks(remaining, 'result')})"
    long_run = (
        f"transform(array(struct({low} as low, {high} as high)), e -> "
        f"struct(slice({values}, 1, 2) as first, {rises} as rises, {ends} as ends))[0]"
    )
    short = f"size({values}) <= {TAIL}"
    return f"struct(if({short}, {values}, null) as few, if({short}, null, {long_run}) as long)"


def _least_start(values: str, result: str) -> str:
    """Least start, in hundredths, from which the fold reaches ``result``; found by bisection."""
    middle = "shiftright(span.lo + span.hi, 1)"
    return f"""aggregate(
        sequence(1, 33),
        struct({INT_MIN}L as lo, {INT_MAX}L as hi),
        (span, i) -> if({_fold_ticks(values, middle)} >= {result},
            struct(span.lo as lo, {middle} as hi),
            struct({middle} + 1 as lo, span.hi as hi))).hi"""


def _apply_runs(run_maps: str) -> str:
    """Mean after all runs, the first of which has no mean before it."""

    def after(run: str, from_mean: str, first_mean: str) -> str:
        ticks = halving_ticks(first_mean, f"{run}.long.first[1]")
        end = f"{run}.long.ends[size(filter({run}.long.rises, start -> start <= {ticks}))]"
        return f"if({run}.few is not null, {from_mean}, {hundredths(end)})"

    opening = after(
        f"{run_maps}[0]", _fold(_rest(f"{run_maps}[0].few"), f"{run_maps}[0].few[0]"), f"{run_maps}[0].long.first[0]")
    following = after("run", _fold("run.few", "mean"), halving_mean("mean", "run.long.first[0]"))
    return f"aggregate({_rest(run_maps)}, {opening}, (mean, run) -> {following})"
