"""Model fits: Arrow batches of NumPy work against the input curve of each curve's subject.

``inputs`` has one row a subject: its columns besides ``c_a`` and ``t_s`` tell subjects apart and are looked up in the
curves, so one job fits a whole cohort. What a model derives from an input curve is prepared once a worker and subject; where
that is dear and there are many subjects, curves are first brought together by subject.

What goes wrong stays with the curves that it concerns: with ``errors`` every row says why it has no numbers, and all
others are as they would be alone.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.functions.tables import checkpointed

#: Input curves of up to so many bytes go to the tasks as one table; more of them are joined to the curves.
INPUT_BYTES = 64 << 20
#: Prepared input curves that a task keeps.
PREPARED = 16


@dataclass(frozen=True)
class Model:
    """prepare(c_a, t, **options) -> context, None if nothing can be fitted; kernel(values[B, T], context, carried) -> arrays by output."""

    outputs: tuple[str, ...]
    prepare: Callable[..., dict | None]
    kernel: Callable[[np.ndarray, dict, dict[str, np.ndarray]], dict[str, np.ndarray]]
    carried: tuple[str, ...] = ()
    options: dict = field(default_factory=dict)
    batch: int = 2048
    #: Preparing an input curve takes seconds: a task should meet few subjects, one after the other.
    dear: bool = False
    #: Takes random numbers that belong to a curve, by its keys, when this option is set.
    drawn: str | None = None


MODELS: dict[str, Model] = {}


def register_model(name: str, model: Model) -> None:
    if name in MODELS:
        raise ValueError(f"model {name} is registered already")
    MODELS[name] = model


def subject_columns(inputs: DataFrame) -> list[str]:
    return [c for c in inputs.columns if c not in ("c_a", "t_s")]


def ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, starts and lengths of a list column; a null list has length -1, a null value is NaN."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat, np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))[:-1]]).astype(np.int64) if len(lengths) else lengths, lengths


def _number(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(float) if pa.types.is_floating(column.type) else column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def over_inputs(
    df: DataFrame,
    inputs: DataFrame,
    prepare: Callable[[np.ndarray, np.ndarray], dict | None],
    kernel: Callable[[np.ndarray | None, dict, dict[str, np.ndarray]], dict],
    *,
    keys: Sequence[str],
    outputs: dict[str, str],
    values: str | None = "values",
    carried: Sequence[str] = (),
    batch: int = 2048,
    errors: bool = False,
    dear: bool = False,
) -> DataFrame:
    """keys and outputs (name: type) of every row of df, by a kernel over the rows of one subject and length.

    Curves and input curves are cut to their common length. Rows that have no curve or whose subject has no input
    curve get nulls, as do results that are not numbers and curves whose equations have no solution. With ``errors`` there
    is a column ``error``: null where the kernel ran, else why not, and what ``prepare`` or the kernel raise is caught: for an
    input curve it concerns its subject, for a batch the rows that raise alone. Without it all but unsolvable equations
    end the job. With ``dear``, curves of more than PREPARED subjects are range-partitioned by subject and, within it, by
    keys, so each task prepares its few subjects once, and large subjects are several tasks.
    """
    if errors and "error" in outputs:
        raise ValueError("error is the name of the column that says what went wrong")
    inputs = checkpointed(inputs)
    subject = subject_columns(inputs)
    if missing := [c for c in subject if c not in df.columns]:
        raise ValueError(f"the curves lack {missing}, by which the input curves are told apart")
    size = inputs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("c_a")), F.lit(0)).alias("frames")).first()
    if not subject and size["n"] > 1:
        raise ValueError("several input curves need a column that tells their subjects apart")
    columns = [*dict.fromkeys([*keys, *subject, *carried, *([values] if values else [])])]
    table, known = df.select(*columns), None
    if 16 * size["frames"] <= INPUT_BYTES:
        rows = {tuple(r[c] for c in subject): (np.array(r["c_a"], float), np.array(r["t_s"], float)) for r in inputs.collect()}
        known = df.sparkSession.sparkContext.broadcast(rows)
    elif subject:
        table = table.join(inputs.select(*subject, "c_a", "t_s"), subject, "left").select(*columns, "c_a", "t_s")
    else:
        table = table.crossJoin(F.broadcast(inputs.select("c_a", "t_s").limit(1)))

    if dear and subject and size["n"] > PREPARED:
        table = table.repartitionByRange(*subject, F.xxhash64(*keys)).sortWithinPartitions(*subject)
    caught = Exception if errors else np.linalg.LinAlgError

    def said(e: Exception) -> str:
        return f"{type(e).__name__}: {e}"[:500]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: OrderedDict = OrderedDict()

        def context(key: tuple, n: int | None, given) -> tuple[dict | None, str | None]:
            if (key, n) not in ready:
                try:
                    known = given is not None and all(np.isfinite(x[:n]).any() for x in given)
                    made = prepare(given[0][:n], given[1][:n]) if known else None
                    ready[key, n] = made, None if made is not None else "no input curve" if given is None else "the input curve allows no fit" if known else "the input curve has no numbers"
                except Exception as e:
                    if not errors:
                        raise
                    ready[key, n] = None, said(e)
                if len(ready) > PREPARED:
                    ready.popitem(last=False)
            return ready[key, n]

        def attempt(block, made: dict, numbers: dict, n: int) -> Iterator[tuple[slice, dict | None, str | None]]:
            """The kernel's results; of a batch that raises, row by row."""
            try:
                with np.errstate(all="ignore"):
                    yield slice(0, n), kernel(block, made, numbers), None
            except caught as e:
                if n == 1:
                    yield slice(0, 1), None, said(e)
                    return
                for i in range(n):
                    one = slice(i, i + 1)
                    for _, found, error in attempt(None if block is None else block[one], made, {c: v[one] for c, v in numbers.items()}, 1):
                        yield one, found, error

        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                part = whole.slice(at, batch)
                column = dict(zip(part.schema.names, part.columns))
                who = list(zip(*[column[c].to_pylist() for c in subject])) if subject else [()] * part.num_rows
                numbers = {c: _number(column[c]) for c in carried}
                flat, starts, lengths = ragged(column[values]) if values else (None, None, np.zeros(part.num_rows, np.int64))
                wrong = [None if n >= 0 else "no curve" for n in lengths.tolist()]
                groups: dict = {}
                for row, (key, n) in enumerate(zip(who, lengths.tolist())):
                    if n >= 0:
                        groups.setdefault((key, n), []).append(row)
                out: dict = {o: np.full(part.num_rows, np.nan) if t == "double" else [None] * part.num_rows for o, t in outputs.items()}
                for (key, n), members in groups.items():
                    given = known.value.get(key) if known else tuple(np.array(column[c][members[0]].as_py() or [], float) for c in ("c_a", "t_s"))
                    cut = min(len(given[0]), len(given[1]), n if values else len(given[0])) if given else 0
                    made, error = context(key, cut, given if cut else None)
                    rows = np.array(members)
                    if made is None:
                        for r in members:
                            wrong[r] = error
                        continue
                    block = flat[starts[rows][:, None] + np.arange(cut)] if values else None
                    for some, found, error in attempt(block, made, {c: v[rows] for c, v in numbers.items()}, len(rows)):
                        if found is None:
                            wrong[members[some.start]] = error
                            continue
                        for o, t in outputs.items():
                            if t == "double":
                                out[o][rows[some]] = found[o]
                            else:
                                for r, v in zip(members[some], found[o]):
                                    out[o][r] = v
                made = [pa.array(v, mask=~np.isfinite(v)) if outputs[o] == "double" else pa.array(v, pa.list_(pa.float64())) for o, v in out.items()]
                if errors:
                    made.append(pa.array(wrong, pa.string()))
                yield pa.record_batch([*[column[k] for k in keys], *made], [*keys, *outputs, *(["error"] if errors else [])])

    types = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys]
    return table.mapInArrow(run, ", ".join([*types, *[f"{o} {t}" for o, t in outputs.items()], *(["error string"] if errors else [])]))


def fit_model(curves: DataFrame, inputs: DataFrame, model: str, *, keys: Sequence[str], batch: int | None = None, errors: bool = False, **options) -> DataFrame:
    """keys and the model's outputs of every curve in ``values``; columns that the model can use are passed if they are there.

    ``errors`` adds the column error, as in ``over_inputs``. Models that draw random numbers take them by a hash of the
    curve's keys, or by its column ``seed``, so that neither batches nor partitions matter.
    """
    m = MODELS[model]
    if unknown := set(options) - set(m.options):
        raise ValueError(f"{model} has no option {sorted(unknown)}; it has {sorted(m.options)}")
    chosen = {**m.options, **options}
    if m.drawn and chosen[m.drawn] and "seed" not in curves.columns:
        curves = curves.withColumn("seed", F.xxhash64(*keys).bitwiseAND(F.lit((1 << 53) - 1)))  # a double holds it
    carried = [c for c in m.carried if c in curves.columns]
    return over_inputs(
        curves, inputs, lambda c_a, t: m.prepare(c_a, t, **chosen), m.kernel, keys=keys, outputs=dict.fromkeys(m.outputs, "double"), carried=carried, batch=batch or m.batch, errors=errors, dear=m.dear
    )
