"""For each set of words, the set of a block with the greatest Jaccard, by counting what it shares with every set of the block.

Words of many sets are bits of a set, the others have postings: a query adds counts over arrays as long as the block, so a
pair of sets takes some nanoseconds and is never a row. Nothing is skipped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SCHEMA = "query binary, id string, shared long, either long"
#: Words that are bits: at most so many (a byte counts them), those in more than one of COMMON sets.
BITS, COMMON = 192, 128
#: More than single precision errs by, as a part, and more than measures differ by that are equal in 9 places.
ROUGH, NEAR = 1e-5, 2e-9


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Where each list begins (and the last one ends) among all elements, and these."""
    lists = lists.combine_chunks()
    at = lists.offsets.to_numpy()
    return at - at[0], lists.flatten()


class Block:
    """sets: key (different words, joined by blanks) and ids (ascending)."""

    def __init__(self, sets: pa.Table):
        at, words = _flat(pc.split_pattern(sets["key"], " "))
        self.sizes = np.diff(at).astype(np.int64)
        n = len(self.sizes)
        coded = words.dictionary_encode()
        self.vocabulary, codes = coded.dictionary, coded.indices.to_numpy()
        df = np.bincount(codes, minlength=len(self.vocabulary))
        self.rows = np.repeat(np.arange(n, dtype=np.int32), self.sizes)[np.argsort(codes, kind="stable")]
        self.starts = np.concatenate([[0], np.cumsum(df)]).tolist()
        common = np.argsort(-df, kind="stable")[:BITS]
        common = common[df[common] * COMMON > n]
        self.bit = np.full(len(df), -1)
        self.bit[common] = np.arange(len(common))
        self.bits = np.zeros((BITS // 64, n), np.uint64)
        for i, w in enumerate(common.tolist()):
            self.bits[i // 64, self.rows[self.starts[w] : self.starts[w + 1]]] |= np.uint64(1 << i % 64)
        self.id_at, self.ids = _flat(sets["ids"])
        self.first = self.ids.take(pa.array(self.id_at[:-1]))
        self.rank = np.empty(n, np.int64)
        self.rank[pc.array_sort_indices(self.first).to_numpy()] = np.arange(n)
        self.size, self.total, self.each = -1, self.sizes, None
        self.both, self.share = np.empty(n, np.uint64), np.empty(n, np.float32)

    def left(self, row: int, without: set[str]) -> str | None:
        """The least id of a set that is none of these."""
        return next((x for x in self.ids[self.id_at[row] : self.id_at[row + 1]].to_pylist() if x not in without), None)

    def best(self, words: np.ndarray, size: int, other: dict[int, str | None]) -> tuple[str, int, int] | None:
        """words: the query's, as codes; size: with those not in the block; other: ids that stand for a set instead of its first."""
        if size != self.size:
            self.size, self.total = size, self.sizes + size
            self.each = (1 / self.total).astype(np.float32)
        bit = self.bit[words]
        rare = [self.rows[self.starts[w] : self.starts[w + 1]] for w in words[bit < 0].tolist()]
        n = len(self.total)
        shared = np.bincount(np.concatenate(rare), minlength=n).astype(np.int32) if rare else np.zeros(n, np.int32)
        mask = sum(1 << i for i in bit[bit >= 0].tolist())
        common = None
        for k in range(BITS // 64):
            if m := mask >> 64 * k & (1 << 64) - 1:
                counts = np.bitwise_count(np.bitwise_and(self.bits[k], np.uint64(m), out=self.both))
                common = counts if common is None else np.add(common, counts, out=common)
        if common is not None:
            shared += common
        for row, x in other.items():
            if x is None:
                shared[row] = 0
        share = np.multiply(shared, self.each, out=self.share, dtype=np.float32, casting="unsafe")  # grows with the Jaccard
        if (most := float(share.max())) <= 0:
            return None
        rows = np.flatnonzero(share >= np.float32(most * (1 - ROUGH) - NEAR))
        n = shared[rows].astype(np.int64)
        either = self.total[rows] - n
        rounded = (2 * 10**9 * n + either) // (2 * either)  # the Jaccard to 9 places, half up
        top = rounded == rounded.max()
        rows, n, either = rows[top], n[top], either[top]
        plain = ~np.isin(rows, list(other)) if other else np.ones(len(rows), bool)
        found = [(other[r], i) for i, r in enumerate(rows.tolist()) if r in other] if other else []
        if plain.any():
            i = np.flatnonzero(plain)[np.argmin(self.rank[rows[plain]])]
            found.append((self.first[int(rows[i])].as_py(), i))
        x, i = min(found)
        return x, int(n[i]), int(either[i])


def nearest(sets: pa.Table, queries: pa.Table) -> pa.Table:
    """sets: see Block. queries: query, key, without (ids that it must not get). Queries that share no word get no row."""
    out = []
    if len(sets) and len(queries):
        block = Block(sets)
        at, words = _flat(pc.split_pattern(queries["key"], " "))
        codes = pc.fill_null(pc.index_in(words, value_set=block.vocabulary), -1).to_numpy(zero_copy_only=False)
        no_at, no_ids = _flat(queries["without"])
        places = pc.fill_null(pc.index_in(no_ids, value_set=block.ids), -1).to_numpy(zero_copy_only=False)
        sizes, names = np.diff(at), queries["query"].combine_chunks()
        for i in np.argsort(sizes, kind="stable").tolist():
            mine = codes[at[i] : at[i + 1]]
            if not len(mine := mine[mine >= 0]):
                continue
            other = {}
            held = places[no_at[i] : no_at[i + 1]]
            if len(held := held[held >= 0]):
                without = set(no_ids[no_at[i] : no_at[i + 1]].to_pylist())
                touched = np.searchsorted(block.id_at, held, side="right") - 1
                other = {r: block.left(r, without) for r in np.unique(touched).tolist()}
            if got := block.best(mine, int(sizes[i]), other):
                out.append((names[i].as_py(), *got))
    columns = list(zip(*out, strict=True)) or [[]] * 4
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["query", "id", "shared", "either"])
