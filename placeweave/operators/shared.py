"""Pairs of rows of one place that share tokens, found block by block.

A join on (place, token) yields a pair once for each token it shares; to keep it once, every such row has to be compared
or shuffled. Here rows are dealt by place, so a task counts what its pairs share, and each pair is made once
and shuffled not at all. Rows of the left side are held as an index of their tokens, those of the right side stream past it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows, and tokens, of the left side in one block, and rows of the right side.
LEFT_ROWS, LEFT_TOKENS, RIGHT_ROWS = 5_000, 2_000_000, 20_000
#: Smaller blocks than these, when asked for, make no more than so many slices of a side, so copies grow with the rows.
SLICES = 32
#: Pairs looked at together, and hits counted together.
CELLS = 1 << 20


def _sliced(left: DataFrame, right: DataFrame, rows_per_slice: int) -> DataFrame:
    """(place, _ln, _rn): the number of slices of each side of places that both have."""

    def cut(n: str, most: int) -> Column:
        return F.greatest(F.ceil(F.col(n) / most), F.least(F.ceil(F.col(n) / rows_per_slice), F.lit(SLICES)))

    l = left.groupBy("place").agg(F.count("*").alias("_l"), F.sum(F.size("tokens")).alias("_t"))
    r = right.groupBy("place").agg(F.count("*").alias("_r"))
    ln = F.greatest(cut("_l", LEFT_ROWS), F.ceil(F.col("_t") / LEFT_TOKENS))
    return l.join(r, "place").select("place", ln.cast("int").alias("_ln"), cut("_r", RIGHT_ROWS).cast("int").alias("_rn"))


def pairs_in_place(left: DataFrame, right: DataFrame, rows_per_slice: int) -> DataFrame:
    """(left, right, n_left, n_right, shared, by_token): ids of rows with the same place that are linked.

    ``left``: id, place, n (handed on), tokens (distinct). ``right`` likewise, with tokens that link without being counted in
    ``shared`` (also), and whether the row is linked with all of its place (every); by_token tells if a token links them.
    """
    slices = _sliced(left, right, rows_per_slice)

    def every_slice(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def own_slice(n: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    none = F.lit(None).cast("array<string>")
    l = left.join(slices, "place").withColumn("a", own_slice("_ln")).withColumn("b", every_slice("_rn"))
    r = right.join(slices, "place").withColumn("b", own_slice("_rn")).withColumn("a", every_slice("_ln"))
    l = l.select("place", "a", "b", F.lit(0).alias("side"), "id", "n", "tokens", none.alias("also"), F.lit(False).alias("every"))
    r = r.select("place", "a", "b", F.lit(1).alias("side"), "id", "n", "tokens", "also", "every")
    blocks = l.unionByName(r).repartition("place", "a", "b").sortWithinPartitions("place", "a", "b", "side")
    cells = CELLS

    def work(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def values(lists):
            """All values of lists, and the row of each; a null list has none."""
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            return lists.flatten(), np.repeat(np.arange(len(lists)), sizes)

        def indexed(rows):
            rows = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            flat, at = values(rows.column("tokens"))
            coded = flat.dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            ends = np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))
            return rows.column("id"), rows.column("n"), coded.dictionary, at[order], np.append(0, ends)

        def hits(lists, known, starts):
            """(row, code) of the values that the left side has."""
            flat, at = values(lists)
            codes = pc.index_in(flat, value_set=known)
            there = codes.is_valid().to_numpy(zero_copy_only=False)
            return at[there], codes.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)

        def cells_of(at, codes, posts, starts, n_left):
            """Places (row times n_left plus left row) of hits, a bounded number at a time."""
            sizes = starts[codes + 1] - starts[codes]
            ends = np.cumsum(sizes)
            first = 0
            while first < len(codes):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] - sizes[first] + cells, "right")))
                part = sizes[first:last]
                before = np.cumsum(part) - part
                where = np.arange(part.sum()) + np.repeat(starts[codes[first:last]] - before, part)
                yield np.repeat(at[first:last] * n_left, part) + posts[where]
                first = last

        def found(left, right):
            ids, counts, known, posts, starts = left
            n_left = len(ids)
            step = max(1, cells // n_left)
            for first in range(0, len(right), step):
                rows = right.slice(first, step)
                size = len(rows) * n_left
                every = rows.column("every").to_numpy(zero_copy_only=False).astype(bool)
                counted = hits(rows.column("tokens"), known, starts)
                also = hits(rows.column("also"), known, starts)
                work_of = sum(int((starts[c + 1] - starts[c]).sum()) for _, c in (counted, also))
                if not every.any() and work_of * 8 < size:
                    both = [np.concatenate([np.empty(0, np.int64), *cells_of(*h, posts, starts, n_left)]) for h in (counted, also)]
                    pairs, back = np.unique(np.concatenate(both), return_inverse=True)
                    shared = np.bincount(back[: len(both[0])], minlength=len(pairs))
                    by_token = np.ones(len(pairs), bool)
                else:
                    shared, other = np.zeros(size, np.int32), np.zeros(size, bool)
                    for c in cells_of(*counted, posts, starts, n_left):
                        shared += np.bincount(c, minlength=size).astype(np.int32)
                    for c in cells_of(*also, posts, starts, n_left):
                        other[c] = True
                    other |= shared > 0
                    pairs = np.flatnonzero(other.reshape(len(rows), n_left) | every[:, None])
                    shared, by_token = shared[pairs], other[pairs]
                if len(pairs):
                    r, l = np.divmod(pairs, n_left)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(l)), rows.column("id").take(pa.array(r)), counts.take(pa.array(l)), rows.column("n").take(pa.array(r)),
                         pa.array(shared.astype(np.int32)), pa.array(by_token)],
                        names=["left", "right", "n_left", "n_right", "shared", "by_token"],
                    )

        block, held, index = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            for c in ("place", "a", "b", "side"):
                column = batch.column(c)
                new[1:] |= pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            cuts = [*np.flatnonzero(new).tolist(), batch.num_rows]
            for first, last in zip(cuts, cuts[1:]):
                rows = batch.slice(first, last - first)
                at = tuple(rows.column(c)[0].as_py() for c in ("place", "a", "b"))
                if at != block:
                    block, held, index = at, [], None
                if rows.column("side")[0].as_py() == 0:
                    held.append(rows)
                elif held or index:
                    if index is None:
                        index, held = indexed(held), []
                    yield from found(index, rows)

    return blocks.mapInArrow(work, "left string, right string, n_left long, n_right long, shared int, by_token boolean")
