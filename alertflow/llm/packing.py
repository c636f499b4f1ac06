"""Best-fit packing of documents into sequences, improved by swap-based local search.

Documents are tokenised whole; only those longer than a sequence are cut. The
pieces are dealt by a hash into blocks of bounded size. Each block is packed by
best fit, then searched: an underfull bin's document is moved to another bin, or
exchanged one for one or two for one with a fuller bin's, whenever that raises the
sum of squared fills, until the emptiest bins are empty. The bins a block leaves
less than half full are dissolved and packed once more across blocks.

Defined results: null text counts as empty; an empty document is one piece (its
end id); rows that repeat an id are packed as separate documents; no rows give
no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertflow.llm.common import written
from alertflow.llm.tokens import cache_for

BLOCK_PIECES = 1 << 15  # pieces packed together in one task
EFFORT = 20  # exchanges tried per bin before the search ends
DONORS = 8  # emptiest bins whose document pairs are tried
PAIRS = 24  # documents of a bin, or of one length, looked at for pairs
_PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, vocab: str, size: int, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's ids, cut only beyond ``size``: one narrow row per piece."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches):
        cache = cache_for(vocab)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            out: list[list[int]] = [[], [], [], [], [], []]
            texts = batch.column("text").to_pylist()
            for doc, enc in zip(batch.column("doc_id").to_pylist(), cache.encode(texts)):
                enc += end
                for k, at in enumerate(range(0, len(enc), 4 * size)):
                    ids = enc[at:at + 4 * size]
                    for c, x in zip(out, (row, doc, k, at // 4, len(ids) // 4, zlib.crc32(ids))):
                        c.append(x)
                    row += 1
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             ["row", "doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(cut, _PIECES)


class Bins:
    """Bins of one block: best fit first, then exchanges that raise the squared fill."""

    def __init__(self, lengths, size: int):
        self.size = size
        self.lengths = [int(x) for x in lengths]
        self.bins: list[list[int]] = []
        self.slack: list[int] = []
        self._best_fit()
        self._search()

    def _best_fit(self) -> None:
        """Longest first, each into the fullest bin that takes it."""
        open_bins: dict[int, list[int]] = {}
        mask = 0  # bit s: some bin has slack s
        for i in sorted(range(len(self.lengths)), key=lambda i: (-self.lengths[i], i)):
            need = self.lengths[i]
            fits = mask >> need
            if fits:
                s = need + (fits & -fits).bit_length() - 1
                b = open_bins[s].pop()
                if not open_bins[s]:
                    mask ^= 1 << s
                self.bins[b].append(i)
            else:
                b, s = len(self.bins), self.size
                self.bins.append([i])
                self.slack.append(s)
            s -= need
            self.slack[b] = s
            if s:
                open_bins.setdefault(s, []).append(b)
                mask |= 1 << s

    def _search(self) -> None:
        """Exchange documents between underfull bins while the spare room could hold a bin."""
        effort = EFFORT * len(self.bins)
        self.home = {i: b for b, items in enumerate(self.bins) for i in items}
        while effort > 0:
            under = sorted((b for b in range(len(self.bins)) if self.slack[b] and self.bins[b]),
                           key=lambda b: (self.slack[b], b))
            if len(under) < 2 or sum(self.slack[b] for b in under) < self.size:
                return
            # documents of underfull bins by length, and the lengths there are as a bit mask
            self.at: dict[int, dict[int, None]] = {}
            self.mask = 0
            for b in under:
                for i in self.bins[b]:
                    self._list(i)
            emptiest = under[:-1 - DONORS:-1]
            found = 0
            for b in under:
                while effort > 0 and self.slack[b] and self.bins[b]:
                    move = self._best_exchange(b, emptiest)
                    if move is None:
                        break
                    self._exchange(b, *move)
                    effort -= 1
                    found += 1
            if not found:
                return

    def _list(self, i: int) -> None:
        self.at.setdefault(self.lengths[i], {})[i] = None
        self.mask |= 1 << self.lengths[i]

    def _unlist(self, i: int) -> None:
        n = self.lengths[i]
        del self.at[n][i]
        if not self.at[n]:
            del self.at[n]
            self.mask ^= 1 << n

    def _best_exchange(self, b: int, emptiest: list[int]):
        """(donor, given by it, given back, gain) that fills ``b`` most within its room, or None.

        Moves, one-for-one and one-for-two take any underfull bin's document;
        two-for-one and two-for-two take a pair of one of the emptiest bins. With
        fills f (of b) and g (donor), the sum of squares rises by
        ``2 * gain * (f - g + gain)``, so only exchanges with a positive value count.
        """
        L, room = self.lengths, self.slack[b]
        backs = {0: ()}
        for i in self.bins[b]:
            backs.setdefault(L[i], (i,))
        few = self.bins[b] if len(self.bins[b]) <= PAIRS else ()
        for k, i in enumerate(few):
            for j in few[k + 1:]:
                backs.setdefault(L[i] + L[j], (i, j))
        best, gain = None, 0
        for back, items in backs.items():
            window = (self.mask >> (back + 1)) & ((1 << room) - 1)  # lengths back + 1 .. back + room
            while window.bit_length() > gain:
                d = window.bit_length()
                window ^= 1 << (d - 1)
                donor = self._donor(back + d, b, d)
                if donor is not None:
                    best, gain = (self.home[donor], (donor,), items, d), d
        if gain < room:
            for a in emptiest:
                if a == b or not self.bins[a] or len(self.bins[a]) > PAIRS:
                    continue
                mine = self.bins[a]
                for k, i in enumerate(mine):
                    for j in mine[k + 1:]:
                        for back, items in backs.items():
                            d = L[i] + L[j] - back
                            if gain < d <= room and d > room - self.slack[a]:
                                best, gain = (a, (i, j), items, d), d
        return best

    def _donor(self, length: int, b: int, gain: int) -> int | None:
        """A document of that length in the emptiest other bin that may give it."""
        pick = None
        for n, i in enumerate(self.at[length]):
            a = self.home[i]
            if a != b and gain > self.slack[b] - self.slack[a] and (pick is None or self.slack[a] > self.slack[self.home[pick]]):
                pick = i
            if n >= PAIRS and pick is not None:
                break  # one that may give is found, and many were looked at
        return pick

    def _exchange(self, b: int, a: int, give: tuple, back: tuple, gain: int) -> None:
        for i in give:
            self.bins[a].remove(i)
            self.bins[b].append(i)
            self.home[i] = b
        for i in back:
            self.bins[b].remove(i)
            self.bins[a].append(i)
            self.home[i] = a
        self.slack[b] -= gain
        self.slack[a] += gain
        if not self.slack[b]:
            for i in self.bins[b]:
                self._unlist(i)


def _pack_block(size: int):
    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row", ignore_index=True)
        packed = Bins(pdf["length"].to_numpy(), size)
        bin_no = np.zeros(len(pdf), dtype=np.int64)
        offset = np.zeros(len(pdf), dtype=np.int64)
        for b, items in enumerate(packed.bins):
            at = 0
            for i in items:
                bin_no[i], offset[i] = b, at
                at += packed.lengths[i]
        fill = np.zeros(len(packed.bins), dtype=np.int64)
        np.add.at(fill, bin_no, pdf["length"].to_numpy())
        return pdf.assign(bin=bin_no, offset=offset, fill=fill[bin_no])
    return pack


def _round(pieces: DataFrame, size: int, n: int) -> DataFrame:
    blocks = max(1, -(-n // BLOCK_PIECES))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    schema = _PIECES + ", block long, bin long, offset long, fill long"
    return dealt.groupBy("block").applyInPandas(_pack_block(size), schema)


def pack(docs: DataFrame, vocab: str, size: int = 2048, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``: ``doc_id, piece, start, length, ids_crc32, ...``."""
    pieces = written(token_pieces(docs, vocab, size, end_id, id_col, text_col), "pieces")
    first = written(_round(pieces.where(F.col("length") < size), size,
                           pieces.where(F.col("length") < size).count()), "packed")
    loose = first.where(F.col("fill") * 2 < size)
    base = [F.col(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
    again = _round(loose.drop("block", "bin", "offset", "fill"), size, loose.count())
    # sequence numbers of the three origins share no value: the last two digits of base 4 differ
    number = (F.col("block") * F.lit(1 << 20) + F.col("bin")) * 4
    return (pieces.where(F.col("length") >= size)
            .select(*base, (F.col("row") * 4 + 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
            .unionByName(first.where(F.col("fill") * 2 >= size).select(*base, number.alias("sequence_id"), "offset"))
            .unionByName(again.select(*base, (number + 1).alias("sequence_id"), "offset")))
