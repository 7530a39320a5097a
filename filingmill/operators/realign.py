"""Two extractions of one report aligned cell by cell, so that a new run keeps a reviewer's decisions.

A report's file is the same in both runs, hence also its pages. Within a page the rows of the two runs are aligned
by the longest common subsequence of their labels, in order of table and row, and the cells of aligned rows by
that of their texts. Nothing larger than a page meets in one place.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import zip_longest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingmill.functions.exprs import normalized_text, stable_id
from filingmill.operators.corrections import FIELDS

PAGE = ("report_id", "page_number")
#: Bits that a traceback may hold; longer pairs are halved first.
HELD_BITS = 1 << 28
SPOT = ("table_index_on_page", "row_index")
#: Where a cell without a place lies: before all others.
NOWHERE = -1 << 62


def _vectors(a: Sequence[str], b: Sequence[str]) -> Iterator[int]:
    """For every prefix of ``a`` the bits of ``b``: a zero at j where one more element of ``b`` makes the subsequence longer."""
    at: dict[str, int] = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & at.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _lengths(a: Sequence[str], b: Sequence[str]) -> list[int]:
    """The lengths of the longest common subsequences of ``a`` and every prefix of ``b``."""
    last = (1 << len(b)) - 1
    for last in _vectors(a, b):  # noqa: B007
        pass
    out = [0]
    for bit in reversed(bin(last)[2:].zfill(len(b)) if b else ""):
        out.append(out[-1] + (bit == "0"))
    return out


def common(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """The places of a longest common subsequence, in order.

    A machine word does 64 steps of the comparison; memory stays below ``HELD_BITS`` as long pairs are halved where the halves
    share most.
    """
    start, n, m = 0, len(a), len(b)
    while start < min(n, m) and a[start] == b[start]:
        start += 1
    while n > start and m > start and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    out = [(i, i) for i in range(start)]
    x, y = a[start:n], b[start:m]
    if len(x) > 1 and len(x) * len(y) > HELD_BITS:
        half = len(x) // 2
        before, after = _lengths(x[:half], y), _lengths(x[half:][::-1], y[::-1])
        cut = max(range(len(y) + 1), key=lambda j: before[j] + after[len(y) - j])
        out += [(start + i, start + j) for i, j in common(x[:half], y[:cut])]
        out += [(start + half + i, start + cut + j) for i, j in common(x[half:], y[cut:])]
    elif x and y:
        held, back, i, j = list(_vectors(x, y)), [], len(x), len(y)
        while i and j:
            if x[i - 1] == y[j - 1]:
                i, j = i - 1, j - 1
                back.append((start + i, start + j))
            elif held[i - 1] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
        out += back[::-1]
    return out + [(n + i, m + i) for i in range(len(a) - n)]


def merged(a: Sequence[str], b: Sequence[str], gaps: bool) -> list[tuple[int | None, int | None]]:
    """Both sequences as one: common places together, others alone, or between two common ones side by side with ``gaps``."""
    out, i, j = [], 0, 0
    for x, y in [*common(a, b), (len(a), len(b))]:
        left, right = range(i, x), range(j, y)
        out += zip_longest(left, right) if gaps else [*((k, None) for k in left), *((None, k) for k in right)]
        out.append((x, y))
        i, j = x + 1, y + 1
    return out[:-1]


def _listed(column: pa.Array) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """The number of its page for every element of lists of structs, and the structs' fields."""
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    held = column.flatten()
    return np.repeat(np.arange(len(column)), counts), dict(zip((f.name for f in held.type), held.flatten()))


def _codes(column: pa.Array) -> np.ndarray:
    """A number for each value, -1 for null."""
    return pc.fill_null(pc.dictionary_encode(column).indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _shared(left: np.ndarray, a: np.ndarray, right: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of a longest common subsequence of ``a`` and ``b`` within every group, in order; groups ascend on both sides.

    Equal groups, and groups whose common values occur once on each side in the same order, leave no choice and are met
    all at once; others are compared one by one (``common``).
    """
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    n, values = 1 + max(left[-1], right[-1]), 1 + max(a.max(), b.max())
    counts = np.bincount(left, minlength=n), np.bincount(right, minlength=n)
    equal = counts[0] == counts[1]
    i, j = np.flatnonzero(equal[left]), np.flatnonzero(equal[right])
    equal[left[i[a[i] != b[j]]]] = False
    i, j = np.flatnonzero(equal[left]), np.flatnonzero(equal[right])
    x, y = np.flatnonzero(~equal[left]), np.flatnonzero(~equal[right])
    held = [np.unique(g[k] * values + v[k], return_index=True, return_counts=True) for g, v, k in ((left, a, x), (right, b, y))]
    _, u, v = np.intersect1d(held[0][0], held[1][0], assume_unique=True, return_indices=True)
    x, y, often = x[held[0][1][u]], y[held[1][1][v]], (held[0][2][u] > 1) | (held[1][2][v] > 1)
    order = np.argsort(x)
    x, y, often = x[order], y[order], often[order]
    often[1:] |= np.diff(y) < 0
    hard = np.zeros(n, bool)
    hard[left[x[often]]] = True
    easy = ~hard[left[x]]
    found = [np.stack((i, j)), np.stack((x[easy], y[easy]))]
    ends = [np.cumsum(c) for c in counts]
    for g in np.flatnonzero(hard).tolist():
        s, t = (int(e[g] - c[g]) for e, c in zip(ends, counts))
        pairs = np.array(common(a[s : ends[0][g]].tolist(), b[t : ends[1][g]].tolist()), np.int64).reshape(-1, 2)
        found.append(np.stack((pairs[:, 0] + s, pairs[:, 1] + t)))
    both = np.concatenate(found, axis=1)
    both = both[:, np.argsort(both[0], kind="stable")]
    return both[0], both[1]


def _beside(left: np.ndarray, a: np.ndarray, right: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``a`` its partner among ``b`` of the same group, or -1: a common value, or one as far behind the same common value."""
    i, j = _shared(left, a, right, b)

    def behind(groups: np.ndarray, at: np.ndarray) -> np.ndarray:
        met = np.zeros(len(groups), np.int64)
        met[at] = 1
        return np.cumsum(met) + groups  # differs by group and by the common value that was met last

    x, y = behind(left, i), behind(right, j)
    n = 1 + max(x.max(initial=0), y.max(initial=0))
    counts = [np.bincount(z, minlength=n) for z in (x, y)]
    starts = [np.cumsum(c) - c for c in counts]
    far = np.arange(len(x)) - starts[0][x]
    return np.where(far < counts[1][x], starts[1][x] + far, -1)


def _cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray, dict[str, pa.Array]]:
    """The cells of pages in order of page, run, row and column: their pages, whether they start a row, and their fields."""
    page, held = _listed(column)
    places = [pc.fill_null(held[c].cast(pa.int64()), NOWHERE).to_numpy(zero_copy_only=False) for c in (*SPOT, "column_index")]
    row = [page, held["new"].to_numpy(zero_copy_only=False), *places[:-1]]

    def differs(columns: Iterable[np.ndarray], order: np.ndarray) -> np.ndarray:
        out = np.ones(len(order), bool)
        out[1:] = False
        for c in columns:
            c = c[order]
            out[1:] |= c[1:] != c[:-1]
        return out

    order = np.lexsort((places[-1], *row[::-1]))
    if not differs([*row, places[-1]], order).all():
        ranks = [pc.rank(held[c], tiebreaker="dense").to_numpy() for c in ("symbol", "raw_cell_id")]
        order = np.lexsort((*ranks, places[-1], *row[::-1]))
    starts = differs(row, order)
    if (order[1:] > order[:-1]).all():
        return page, starts, held
    at = pa.array(order)
    return page[order], starts, {k: v.take(at) for k, v in held.items()}


def _aligned(page: np.ndarray, starts: np.ndarray, cells: dict[str, pa.Array], apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of both runs' cells beside each other, -1 where there is none, and a number for each text.

    Cells are as ``_cells`` gives them; ``apart`` says which pages have no key.
    """
    fresh = cells["new"].to_numpy(zero_copy_only=False)
    lines, line = np.flatnonzero(starts), np.cumsum(starts) - 1
    symbols = _codes(cells["symbol"])
    at = pa.array(lines)
    labels, pages = _codes(pc.coalesce(cells["label"].take(at), cells["symbol"].take(at))), page[lines]
    old, new = (np.flatnonzero((fresh[lines] == run) & ~apart[pages]) for run in (False, True))
    i, j = _shared(pages[old], labels[old], pages[new], labels[new])
    group = np.full(len(lines), -1)
    group[old[i]] = group[new[j]] = np.arange(len(i))
    group = group[line]
    x, y = (np.flatnonzero((group >= 0) & (fresh == run)) for run in (False, True))
    beside = _beside(group[x], symbols[x], group[y], symbols[y])
    partner = np.full(len(fresh), -1)
    met = beside >= 0
    partner[x[met]] = y[beside[met]]
    added = fresh.copy()
    added[partner[partner >= 0]] = False
    left, right = np.flatnonzero(~fresh), np.flatnonzero(added)
    return np.concatenate((left, np.full(len(right), -1))), np.concatenate((partner[left], right)), symbols


def both_runs(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of two runs in one table, with ``new``."""
    return old.withColumn("new", F.lit(False)).unionByName(new.withColumn("new", F.lit(True)))


def _pages(cells: DataFrame, key: Sequence[str], facts: DataFrame | None = None) -> DataFrame:
    """(key, cells, facts): a row for each page, so that Python is given pages and not millions of small rows."""
    texts = cells.select(*key, "new", *SPOT, "column_index", "raw_cell_id", normalized_text("raw_text").alias("symbol"))
    symbol = F.col("symbol")
    # a label is sent only where it isn't the text itself
    cell = F.struct("new", *SPOT, "column_index", "raw_cell_id", "symbol", F.nullif(F.lower(symbol), symbol).alias("label"))
    rows = texts.select(*key, F.when(symbol.isNotNull(), cell).alias("cell"))
    if facts is not None:
        fact = F.struct("new", "raw_cell_id", "fact_id", "normalized_concept_id", "raw_unit")
        rows = rows.unionByName(facts.select(*key, fact.alias("fact")), allowMissingColumns=True)
    return rows.groupBy(*key).agg(*[F.collect_list(c).alias(f"{c}s") for c in rows.columns[len(key) :]])


def _apart(pages: pa.RecordBatch, width: int) -> np.ndarray:
    """Which pages have a null in their key, the first ``width`` columns."""
    return np.any([pages.column(c).is_null().to_numpy(zero_copy_only=False) for c in range(width)], axis=0)


def aligned_runs(cells: DataFrame, key: Sequence[str] = PAGE) -> DataFrame:
    """``aligned_cells`` of cells of both runs in one table, where ``new`` says which run they are of."""
    pages, width = _pages(cells, key), len(key)
    fields = {f.name: f for f in pages.schema["cells"].dataType.elementType}
    cell = T.StructType([T.StructField(c, fields[c].dataType) for c in ("column_index", *SPOT, "raw_cell_id", "symbol")])
    schema = T.StructType([*[T.StructField(c, pages.schema[c].dataType) for c in key], T.StructField("old", cell), T.StructField("new", cell)])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, starts, held = _cells(batch.column("cells"))
            left, right, _ = _aligned(page, starts, held, _apart(batch, width))
            whose = pa.array(page[np.where(left < 0, right, left)])
            out = [batch.column(c).take(whose) for c in range(width)]
            for x in (left, right):
                own = pa.array(x, mask=x < 0)
                out.append(pa.StructArray.from_arrays([held[c].take(own) for c in cell.names], cell.names, mask=pa.array(x < 0)))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    found = pages.mapInArrow(made, schema)
    same = F.lit(True)
    for c in (*SPOT, "column_index"):
        same = same & (F.col(f"old.{c}") == F.col(f"new.{c}"))
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "gone").when(F.col("old.symbol") != F.col("new.symbol"), "changed").when(same, "kept").otherwise("moved")
    return found.select(*key, kind.alias("kind"), "old", "new")


def aligned_cells(old: DataFrame, new: DataFrame, key: Sequence[str] = PAGE) -> DataFrame:
    """(key, kind, old, new): every cell of two runs once, beside its partner.

    Both have ``key``, table_index_on_page, row_index, column_index, raw_text and raw_cell_id, one cell for each place
    (``rawtables.last_cells``). A row's label is its first text. Kinds: ``kept`` (same text at the same place), ``moved`` (same
    text elsewhere), ``changed`` (another text between the same neighbours), ``gone`` and ``added``. Cells without a
    text are left out; those with a null in the key meet nothing. Cells are dealt once, by page; a task holds some
    pages of both runs at a time, so a page must fit in its memory.
    """
    return aligned_runs(both_runs(old, new), key)


def _met(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of a left join of numbers; -1 where nothing is met. Negative numbers meet nothing."""
    order = np.argsort(right, kind="stable")
    at = right[order]
    first, last = np.searchsorted(at, left), np.searchsorted(at, left, side="right")
    n = np.where(left < 0, 0, last - first)
    times = np.maximum(n, 1)
    i = np.repeat(np.arange(len(left)), times)
    far = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
    j = np.full(len(i), -1)
    j[n[i] > 0] = order[(first[i] + far)[n[i] > 0]]
    return i, j


def _outcomes(pages: pa.RecordBatch, width: int) -> pa.RecordBatch:
    """The old run's facts with what becomes of them, from pages with cells and facts."""
    page, starts, cells = _cells(pages.column("cells"))
    left, right, symbols = _aligned(page, starts, cells, _apart(pages, width))
    left, right = left[left >= 0], right[left >= 0]
    whose, facts = _listed(pages.column("facts"))
    ids, spots = _codes(pa.concat_arrays([cells["raw_cell_id"], facts["raw_cell_id"]])), np.concatenate((page, whose))
    ids = np.where(ids < 0, -1, spots * (1 + ids.max(initial=0)) + ids)
    ids, held = ids[: len(page)], ids[len(page) :]
    concept, unit = _codes(facts["normalized_concept_id"]), _codes(facts["raw_unit"])
    fresh = facts["new"].to_numpy(zero_copy_only=False)
    olds, news = np.flatnonzero(~fresh), np.flatnonzero(fresh)
    i, at = _met(held[olds], ids[left])
    new = np.full(len(at), -1)
    new[at >= 0] = right[at[at >= 0]]
    changed, cell = np.zeros(len(at), bool), np.full(len(at), -1)
    changed[new >= 0] = symbols[left[at[new >= 0]]] != symbols[new[new >= 0]]
    cell[new >= 0] = ids[new[new >= 0]]
    found, fact = _met(cell, held[news])
    mine = olds[i[found]]
    fact[fact >= 0] = news[fact[fact >= 0]]
    fact[(fact >= 0) & (concept[mine] != concept[fact])] = -1
    # where no fact of the cell has the concept, one row stays
    keep = fact >= 0
    first = np.ones(len(found), bool)
    first[1:] = found[1:] != found[:-1]
    keep |= first & (np.bincount(found[keep], minlength=len(i)) == 0)[found]
    found, mine, fact = found[keep], mine[keep], fact[keep]
    tests = [at[found] < 0, new[found] < 0, changed[found], fact < 0, unit[mine] != unit[fact]]
    outcome = np.select(tests, range(len(tests)), len(tests))
    other = np.where(outcome == len(tests), fact, -1)
    said = pa.array(["no_cell", "gone", "changed", "no_fact", "unit", "carried"]).take(pa.array(outcome))
    ident = facts["fact_id"]
    return pa.RecordBatch.from_arrays([ident.take(pa.array(mine)), said, ident.take(pa.array(other, mask=other < 0))], names=["fact_id", "outcome", "new_fact_id"])


def outcomes_on_pages(facts: DataFrame, cells: DataFrame, key: Sequence[str] = PAGE) -> DataFrame:
    """``outcomes`` of facts that have their cell's ``key``: each page's cells and facts meet where the page is aligned.

    Both tables hold both runs, with ``new``. They are dealt once, by page; no aligned cell and no fact is shuffled again.
    """
    pages, width, ident = _pages(cells, key, facts), len(key), facts.schema["fact_id"].dataType
    schema = T.StructType([T.StructField("fact_id", ident), T.StructField("outcome", T.StringType()), T.StructField("new_fact_id", ident)])
    return pages.mapInArrow(lambda batches: (_outcomes(x, width) for x in batches), schema)


def outcomes(old_facts: DataFrame, new_facts: DataFrame, cells: DataFrame) -> DataFrame:
    """(fact_id, outcome, new_fact_id): what becomes of facts in a new run.

    ``carried`` if the cell's text is the same, wherever it stands, and the new run has a fact of the same concept and unit there; else why
    not: ``no_cell``, ``gone``, ``changed``, ``no_fact`` or ``unit``. A fact that isn't carried has no new_fact_id.
    """
    moves = cells.where("old is not null").select(F.col("old.raw_cell_id").alias("__old"), "kind", F.col("new.raw_cell_id").alias("__new"))
    at = old_facts.select("fact_id", "raw_cell_id", "normalized_concept_id", F.col("raw_unit").alias("__unit")).join(moves, F.col("raw_cell_id") == F.col("__old"), "left")
    found = new_facts.select(F.col("fact_id").alias("__fact"), F.col("raw_cell_id").alias("__cell"), F.col("normalized_concept_id").alias("__concept"), "raw_unit")
    at = at.join(found, (F.col("__new") == F.col("__cell")) & F.col("normalized_concept_id").eqNullSafe(F.col("__concept")), "left")
    outcome = F.when(F.col("kind").isNull(), "no_cell").when(F.col("kind").isin("gone", "changed"), F.col("kind")).when(F.col("__fact").isNull(), "no_fact")
    outcome = outcome.when(~F.col("__unit").eqNullSafe(F.col("raw_unit")), "unit").otherwise("carried")
    return at.select("fact_id", outcome.alias("outcome"), F.when(outcome == "carried", F.col("__fact")).alias("new_fact_id"))


def carried(log: DataFrame, found: DataFrame, new_facts: DataFrame, new_log: DataFrame, batch_id: str, created_at) -> DataFrame:
    """Rows of ``corrections`` for the new run: the latest decision on each field of facts that are carried.

    ``found`` is of ``outcomes``. A field that was already decided in the new run (``new_log``) stays as it is there.
    """
    last = F.max_by(F.struct("new_value", "correction_reason"), F.struct("created_at", "correction_id")).alias("d")
    decided = log.groupBy("fact_id", "field_name").agg(last).select("fact_id", "field_name", "d.*")
    moved = decided.join(found.where("outcome = 'carried'"), "fact_id").select(F.col("new_fact_id").alias("fact_id"), "field_name", "new_value", "correction_reason")
    moved = moved.join(new_log.select("fact_id", "field_name").distinct(), ["fact_id", "field_name"], "left_anti")
    held = F.map_from_arrays(F.array(*[F.lit(f) for f in FIELDS.values()]), F.array(*[F.col(f).cast("string") for f in FIELDS.values()]))
    out = moved.join(new_facts.select("fact_id", held.alias("__held")), "fact_id").withColumn("old_value", F.try_element_at("__held", F.col("field_name"))).drop("__held")
    out = out.withColumns({"correction_batch_id": F.lit(batch_id), "created_at": created_at})
    return out.withColumn("correction_id", stable_id("correction_batch_id", "fact_id", "field_name"))
