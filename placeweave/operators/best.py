"""The best documents of a batch of queries, found document by document.

Rows of hits are dealt by document, so all that a query needs to know of a document lies in one task: which of its
tokens are there, their sum, and how close they stand in the title. A task keeps the best ``n`` documents
of each query; only these are shuffled, not every document that matches.

Results are those of ``search.combine`` and ``search.top_hits``, to the bit: the same order of the same sums.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_BLOCK, PAIRS_AT_ONCE, HELD = 400_000, 1_000_000, 1_000_000
NO_DOCUMENT = -(2**63)  # stands for a null doc_id, and sorts like it


class Asked(NamedTuple):
    """One query: the numbers of its tokens, their places in it, and if any of them will do."""

    any_token: bool
    n_tokens: int
    tokens: list[int]
    ords: list[int]


def best_in_tasks(rows: DataFrame, asked: list[Asked], n: int, unit: int, phrase: tuple[int, float] | None = None) -> DataFrame:
    """(query, doc_id, units): for each task, the best ``n`` documents of each query, which is its place in ``asked``.

    ``rows``: doc_id, token (its number), units; with ``phrase`` (slop, boost) also positions, idf and norm of
    the token's row of the title, null in other rows.
    """
    shared = rows.sparkSession.sparkContext.broadcast([tuple(a) for a in asked])  # workers need not know the class
    block_rows, pairs_at_once, held_rows, no_document = ROWS_PER_BLOCK, PAIRS_AT_ONCE, HELD, NO_DOCUMENT

    def work(batches):
        import numpy as np
        import pyarrow as pa

        queries = shared.value
        n_queries = len(queries)
        sizes = np.array([len(t) for _, _, t, _ in queries], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        tokens = np.array([t for _, _, ts, _ in queries for t in ts], np.int64)
        ords = np.array([o for _, _, _, os in queries for o in os], np.int64)
        n_tokens = np.array([m for _, m, _, _ in queries], np.int64)
        any_token = np.array([a for a, _, _, _ in queries], bool)
        phrases = (n_tokens > 1) & (sizes == n_tokens)
        every, some = np.flatnonzero(~any_token), np.flatnonzero(any_token)
        n_known = int(tokens.max()) + 1 if len(tokens) else 0
        least = np.full(n_queries, -np.inf)  # the score that a document has to reach
        empty = np.zeros(0, np.int64)
        held = [(empty, empty, empty)]

        def runs(counts):
            """0, 1, ... counts[0] - 1, 0, 1, ... counts[1] - 1, ..."""
            return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)

        def best(parts):
            q, doc, units = (np.concatenate(c) for c in zip(*parts))
            score = units / unit
            order = np.lexsort((doc, -score, q))
            q, doc, units, score = q[order], doc[order], units[order], score[order]
            starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else empty
            rank = runs(np.diff(np.r_[starts, len(q)])) if len(q) else empty
            last = rank == n - 1
            least[q[last]] = score[last]
            kept = rank < n
            return [(q[kept], doc[kept], units[kept])]

        def closeness(of, q, d, title, positions, width):
            """How often and how closely the words of query ``q`` stand together in the title of document ``d``; see ``search.phrase_frequency``."""
            slop = phrase[0]
            key, starts, ends = title
            words = np.repeat(np.arange(len(q)), sizes[q])
            slot = np.repeat(offsets[q], sizes[q]) + runs(sizes[q])
            at = np.searchsorted(key, tokens[slot] * width + d[words])
            counts = ends[at] - starts[at]
            place = positions[np.repeat(starts[at], counts) + runs(counts)]
            pair, word, shift = np.repeat(words, counts), np.repeat(slot - offsets[q][words], counts), place - np.repeat(ords[slot], counts)
            low = int(shift.min()) if len(shift) else 0
            span = (int(shift.max()) - low if len(shift) else 0) + slop + 2
            code = pair * span + (shift - low)
            anchors = np.unique(code)
            whose = anchors // span
            many = int(sizes[q].max()) if len(q) else 0
            ok, furthest = np.ones(len(anchors), bool), np.zeros(len(anchors), np.int64)
            own = np.full((many, len(anchors)), -1, np.int64)
            for j in range(many):
                of_word = np.sort(code[word == j])
                wanted = sizes[q][whose] > j
                i = np.searchsorted(of_word, anchors)
                found = i < len(of_word)
                near = np.where(found, of_word[np.minimum(i, len(of_word) - 1)], -1) if len(of_word) else np.full(len(anchors), -1)
                ok &= ~wanted | (found & (near // span == whose) & (near <= anchors + slop))
                furthest = np.where(wanted, np.maximum(furthest, near), furthest)
                ord_j = ords[np.minimum(offsets[q] + j, len(ords) - 1)][whose]
                own[j] = np.where(wanted, near + ord_j, -2 - j)  # what is not asked for equals nothing
            own.sort(axis=0)
            ok &= ~(own[1:] == own[:-1]).any(axis=0)
            weight = np.where(ok, 1.0 / np.maximum(1 + furthest - anchors, 1), 0.0)
            return np.bincount(whose, weights=weight, minlength=len(of))

        def with_phrases(q, d, units, title, positions, facts, width):
            """Units of query ``q`` in document ``d``, and of its phrase if the title has all words."""
            if title is None or not len(title[0]):
                return units
            key, idf, norm = title[0], *facts
            open_ = np.flatnonzero(phrases[q])
            for j in range(int(sizes[q[open_]].max()) if len(open_) else 0):
                more = sizes[q[open_]] > j
                k = tokens[np.where(more, offsets[q[open_]] + j, 0)] * width + d[open_]
                at = np.minimum(np.searchsorted(key, k), len(key) - 1)
                open_ = open_[~more | ((key[at] == k) & once[at])]
            if not len(open_):
                return units
            pq, pd = q[open_], d[open_]
            tf = closeness(open_, pq, pd, title, positions, width)
            total = np.zeros(len(open_))
            for j in range(int(sizes[pq].max())):  # in the order of words, as sums of floats go by order
                more = sizes[pq] > j
                at = np.minimum(np.searchsorted(key, tokens[np.where(more, offsets[pq] + j, 0)] * width + pd), len(key) - 1)
                total = np.where(more, total + idf[at], total)
            own_norm = norm[np.searchsorted(key, tokens[offsets[pq]] * width + pd)]
            units = units.copy()
            units[open_] += np.floor(phrase[1] * total * (tf / (tf + own_norm)) * unit).astype(np.int64)
            return units

        once = None

        def block(table):
            nonlocal held, once
            doc = table.column("doc_id").to_numpy()
            token = table.column("token").to_numpy().astype(np.int64)
            change = np.r_[True, doc[1:] != doc[:-1]]
            docs, d = doc[change], np.cumsum(change) - 1
            width = len(docs)
            key = token * width + d
            order = np.argsort(key, kind="stable")
            key = key[order]
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            units = np.add.reduceat(table.column("units").to_numpy()[order], starts)
            key = key[starts]
            first = np.searchsorted(key, np.arange(n_known + 1) * width)
            count = np.diff(first)
            title = positions = facts = None
            if phrase:
                column = table.column("positions").combine_chunks()
                column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
                of_title = np.flatnonzero(table.column("norm").is_valid().to_numpy())
                length = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                begin = (np.cumsum(length) - length)[of_title]
                full = (token * width + d)[of_title]
                by_key = np.argsort(full, kind="stable")
                full, begin, length = full[by_key], begin[by_key], length[of_title][by_key]
                single = np.flatnonzero(np.r_[True, full[1:] != full[:-1]]) if len(full) else empty
                once = np.diff(np.r_[single, len(full)]) == 1
                title, positions = (full[single], begin[single], begin[single] + length[single]), flat
                facts = [table.column(c).to_numpy()[of_title][by_key][single] for c in ("idf", "norm")]

            def add(q, dd, sums):
                sums = with_phrases(q, dd, sums, title, positions, facts, width)
                good = sums / unit >= least[q]
                if good.any():
                    held.append((q[good], docs[dd[good]], sums[good]))

            if len(every):
                wanted = count[tokens]
                # the token with the fewest documents leads: only these are looked at
                led = np.minimum.reduceat(wanted * len(tokens) + np.arange(len(tokens)), offsets[:-1])
                n_docs, lead = led // len(tokens), led % len(tokens)
                live = every[n_docs[every] > 0]
                cuts = np.cumsum(n_docs[live]) // pairs_at_once
                for part in np.split(live, np.flatnonzero(np.diff(cuts)) + 1) if len(live) else []:
                    counts = n_docs[part]
                    q, leader = np.repeat(part, counts), np.repeat(lead[part], counts)
                    at = first[tokens[leader]] + runs(counts)
                    dd, sums = key[at] - tokens[leader] * width, units[at]
                    for j in range(int(sizes[part].max())):
                        slot = offsets[q] + j
                        check = (sizes[q] > j) & (slot != leader)
                        k = tokens[np.where(check, slot, leader)] * width + dd
                        at = np.minimum(np.searchsorted(key, k), len(key) - 1)
                        there = key[at] == k
                        sums = np.where(check, sums + units[at], sums)[there]
                        q, dd, leader = q[there], dd[there], leader[there]
                    if len(q):
                        add(q, dd, sums)
                    if sum(len(part[0]) for part in held) > 2 * len(held[0][0]) + held_rows:
                        held = best(held)
            for i in some:
                sums, hit = np.zeros(width, np.int64), np.zeros(width, bool)
                for t in tokens[offsets[i] : offsets[i + 1]]:
                    of = slice(first[t], first[t + 1])
                    dd = key[of] - t * width
                    sums[dd] += units[of]
                    hit[dd] = True
                dd = np.flatnonzero(hit)
                if len(dd):
                    add(np.full(len(dd), i), dd, sums[dd])
            if sum(len(part[0]) for part in held) > 2 * len(held[0][0]) + held_rows or len(held) > 100_000:
                held = best(held)

        waiting, size, limit = [], 0, block_rows
        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size >= limit:
                table = pa.Table.from_batches(waiting).combine_chunks()
                doc = table.column("doc_id").to_numpy()
                cut = int(np.searchsorted(doc, doc[-1]))  # the last document may go on
                if cut:
                    block(table.slice(0, cut).combine_chunks())
                waiting = table.slice(cut).combine_chunks().to_batches()
                size = table.num_rows - cut
                limit = max(block_rows, 2 * size)
        if size:
            block(pa.Table.from_batches(waiting).combine_chunks())
        q, doc, units = best(held)[0]
        for at in range(0, len(q), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(q[part].astype(np.int32)), pa.array(doc[part]), pa.array(units[part])], names=["query", "doc_id", "units"])

    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_DOCUMENT))
    dealt = rows.withColumn("doc_id", number).repartition("doc_id").sortWithinPartitions("doc_id")
    found = dealt.mapInArrow(work, "query int, doc_id long, units long")
    return found.withColumn("doc_id", F.when(F.col("doc_id") != NO_DOCUMENT, F.col("doc_id")))
