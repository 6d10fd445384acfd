"""Packing of token sequences into as few bins as it can.

The bins are planned on the histogram of lengths alone: a configuration linear program, solved by
multiplicative weights with a knapsack for pricing until its cover is within ``GAP`` of the dual bound or the
rounds end, then rounded. The histogram has as many entries as a bin has tokens, whatever the corpus. Pieces then take their places by their rank among pieces of the same length.
"""

from __future__ import annotations

import re
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docgroups.llm.batches import bounded, give_back
from docgroups.llm.once import once
from docgroups.session import cut

CAPACITY = 1024
GAP = 0.005
ROUNDS = 800
FIRST_CHECK = 50
STEP = 0.6
SLACK = 0.01
COLUMNS = 8
LONG_BONUS = 0.05
WEIGHT_SHARE = 0.01
RANK_ROWS = 1_000
CACHE_ENTRIES = 400_000
CACHE_IDS = 4_000_000
SLICE_BYTES = 1_500_000  # of text that is cut at once; a longer text is a slice of its own
SLICE_CUTS = 1 << 14  # whose ids are copied at once
LEARN_CUTS = 8_000  # that the tokenizer gets as one text
BLANKS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"  # all that Unicode calls white space
UNSAFE = rf"{BLANKS} | {BLANKS}|^ | $|\x00"


class Encoder:
    """Token ids of texts as bytes, little-endian and unsigned 32-bit.

    The pre-tokeniser never joins what a single blank between two other characters parts, so a text is cut
    there and each distinct cut is encoded once. Texts with other white space next to a blank, and those that hold the
    string of an added token, which the tokenizer gives its own id, go to the tokenizer as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.unsafe = "|".join([UNSAFE, *added])
        self.forget()
        # In a byte-level vocabulary each character of a token stands for one byte.
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.sizes[i] = len(token)

    def ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(x.ids)}I", *x.ids) for x in found]

    def forget(self) -> None:
        """Drop what was learned: a worker's memory is for its next task."""
        self.heads: dict[str, int] = {}  # numbers of cuts as they are
        self.known = pa.array([], pa.string())  # cuts with a blank before them
        self.numbers = np.zeros(0, dtype=np.int64)  # and their numbers
        self.pool = np.zeros(0, dtype="<u4")  # ids of all cuts by number
        self.ends = np.zeros(1, dtype=np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Keep the ids of more cuts, ``sizes`` each, and number them."""
        numbers = np.arange(len(self.ends) - 1, len(self.ends) - 1 + len(sizes))
        self.pool = np.concatenate([self.pool, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        return numbers

    def learn(self, cuts: pa.Array) -> None:
        """Encode cuts, a blank before each, as one text and part its ids where the bytes of a cut end."""
        text = " " + pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(cuts)], pa.int32()), cuts), " ")[0].as_py()
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        bounds = np.cumsum(np.array(pc.binary_length(cuts), dtype=np.int64) + 1)
        at = np.searchsorted(np.cumsum(self.sizes[ids]), bounds) + 1
        self.known = pa.concat_arrays([self.known, cuts])
        self.numbers = np.concatenate([self.numbers, self.add(ids, np.diff(at, prepend=0))])

    def of_words(self, words: pa.Array) -> np.ndarray:
        """Numbers of distinct cuts with a blank before them."""
        at = np.array(pc.index_in(words, value_set=self.known).fill_null(-1))
        fresh = words.filter(pa.array(at < 0))
        at[at < 0] = np.arange(len(self.known), len(self.known) + len(fresh))
        for start in range(0, len(fresh), LEARN_CUTS):
            self.learn(fresh.slice(start, LEARN_CUTS))
        return self.numbers[at]

    def of_heads(self, heads: list[str]) -> list[int]:
        """Numbers of cuts as they are; long ones are whole texts and not kept."""
        fresh = [x for x in dict.fromkeys(heads) if x not in self.heads]
        if fresh:
            found = self.ids(fresh)
            numbers = self.add(np.frombuffer(b"".join(found), dtype="<u4"), np.array([len(x) // 4 for x in found], dtype=np.int64))
            self.heads.update(zip(fresh, numbers.tolist()))
        out = [self.heads[x] for x in heads]
        for text in fresh:
            if len(text) > 64:
                del self.heads[text]
        return out

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, none null, one after the other, and where those of each begin, and the end of all.

        Arrow cuts the texts and tells the cuts apart, so Python meets no word on its own.
        """
        if len(self.ends) > CACHE_ENTRIES or len(self.pool) > CACHE_IDS:
            self.forget()
        whole = pc.match_substring_regex(texts, self.unsafe)
        cuts = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        at = np.array(cuts.offsets, dtype=np.int64)
        at -= at[0]
        words = cuts.flatten()
        del cuts
        words = words.dictionary_encode()
        place, words = np.array(words.indices), words.dictionary
        first = at[:-1]
        later = np.ones(len(place), dtype=bool)
        later[first] = False
        used = np.zeros(len(words), dtype=bool)
        used[place[later]] = True
        number = np.zeros(len(words), dtype=np.int64)
        number[used] = self.of_words(words.filter(pa.array(used)))
        number = number[place]
        number[first] = self.of_heads(pc.if_else(whole, texts, words.take(pa.array(place[first]))).to_pylist())
        total = np.concatenate([[0], np.cumsum(self.ends[number + 1] - self.ends[number])])
        ids = np.empty(total[-1], dtype="<u4")
        for start in range(0, len(number), SLICE_CUTS):
            part = number[start:start + SLICE_CUTS]
            begin, size, to = self.ends[part], self.ends[part + 1] - self.ends[part], total[start:start + len(part) + 1]
            ids[to[0]:to[-1]] = self.pool[np.repeat(begin - to[:-1], size) + np.arange(to[0], to[-1])]
        return ids, total[at]

    def __call__(self, texts: list[str]) -> list[bytes]:
        ids, at = self.flat(pa.array(texts, pa.string()))
        blob = ids.tobytes()
        return [blob[4 * a:4 * b] for a, b in zip(at.tolist(), at[1:].tolist())]


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of the rows with about ``SLICE_BYTES`` of ``text`` each: what cutting a run holds follows its text, not its rows."""
    run = np.cumsum(np.array(pc.binary_length(batch.column("text")).fill_null(0), dtype=np.int64)) // SLICE_BYTES
    ends = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(batch)]
    return (batch.slice(a, b - a) for a, b in zip(ends, ends[1:]) if a < b)


def encoder(path: str) -> Encoder:
    """One for each Python worker; what it has learned is dropped at the end of a task."""
    return once(f"encoder {path}", lambda: Encoder(path))


def pieces(docs: DataFrame, path: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids)`` of ``(doc_id, text)``: the ids of a text and ``end_id``, cut at ``capacity``.

    A null text is an empty one and has the end id alone. Of a longer text the first piece holds what is
    left over, the others ``capacity`` ids each. ``ids`` are bytes, little-endian and unsigned 32-bit.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(path)
        for part in (part for whole in batches for part in slices(whole)):
            ids, at = encode_texts.flat(part.column("text").fill_null(""))
            ids = np.insert(ids, at[1:], end_id).astype("<u4", copy=False)
            size = np.diff(at) + 1
            n = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            head = ((size - 1) % capacity + 1)[row]
            length = np.where(piece == 0, head, capacity)
            start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
            ends = np.concatenate([[0], np.cumsum(4 * length)])
            blobs = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(ends.astype("<i8")), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), blobs.cast(pa.binary()),
            ], ["doc_id", "piece", "start", "length", "ids"])
        encode_texts.forget()
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bounded(docs.select("doc_id", "text")).mapInArrow(encode, f"doc_id {kind}, piece int, start long, length long, ids binary")


def knapsack(values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Most value in each room up to ``capacity``, lengths worth ``values[l]`` each, and a length that attains it."""
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    worth = np.where(values[1:] > 0, values[1:], -np.inf)
    for room in range(1, capacity + 1):
        total = best[room - 1::-1] + worth[:room]
        k = int(total.argmax())
        if total[k] > 0:
            best[room], choice[room] = total[k], k + 1
    return best, choice


def configuration(choice: np.ndarray, first: int, capacity: int) -> Counter:
    """The bin that holds ``first`` and the knapsack's best lengths for the rest."""
    content, room = Counter({first: 1}), capacity - first
    while room > 0 and choice[room]:
        content[int(choice[room])] += 1
        room -= int(choice[room])
    return content


def fill(need: np.ndarray, capacity: int) -> Counter:
    """Bins by configuration, fractions allowed, that cover ``need``: a greedy fill, for what a program leaves open.

    A round prices every open length by its share of a bin, a little more for long ones, which are hard to place.
    One knapsack then gives the best configuration around each of the longest open lengths, and each is used until a
    row of it is covered. So every round closes a row, and there are at most ``capacity`` of them.
    """
    need, share = need.astype(float), np.arange(capacity + 1) / capacity
    covered, log_weight = np.zeros(capacity + 1), np.zeros(capacity + 1)
    picked: Counter = Counter()
    while True:
        live = np.flatnonzero(covered < need - 1e-9)
        if not len(live):
            return picked
        weight = np.exp(log_weight[live] - log_weight[live].max())
        price = np.zeros(capacity + 1)
        price[live] = share[live] * (1 + LONG_BONUS * share[live] + WEIGHT_SHARE * weight)
        choice = knapsack(price, capacity)[1]
        for first in live[::-1][:COLUMNS].tolist():
            content = configuration(choice, first, capacity)
            times = min((need[length] - covered[length]) / n for length, n in content.items())
            if times <= 0:
                continue
            for length, n in content.items():
                covered[length] += n * times
                log_weight[length] -= n * times / need[length]
            picked[tuple(sorted(content.items(), reverse=True))] += times


def configuration_lp(counts: np.ndarray, capacity: int) -> tuple[Counter, float]:
    """Bins by configuration, fractions allowed, that cover ``counts[l]`` pieces of each length l, and a lower bound of any such cover.

    Multiplicative weights over the covering rows. A length is priced by its share of a bin times its weight. A
    knapsack over all lengths gives the best configuration; it and those around any other length that come within
    ``SLACK`` of its value are used until no row grows by more than its whole need, and a row's weight falls by what
    it grew, in steps that shrink with the rounds. Prices divided by the value of the best configuration are a
    solution of the dual program, so they bound every cover from below; the mean of the prices does so as well.

    At rounds 50, 100, 200 and so on the configurations since the last such round are averaged, scaled to the bound,
    and filled up where they fall short. The rounds end when the best cover is within ``GAP`` of the bound, or after ``ROUNDS``.
    """
    need, share = counts.astype(float), np.arange(capacity + 1) / capacity
    live = np.flatnonzero(counts)
    if not len(live):
        return Counter(), 0.0
    cover, bound = fill(need, capacity), 0.0
    log_weight, prices, used, check = np.zeros(capacity + 1), np.zeros(capacity + 1), Counter(), FIRST_CHECK
    for step in range(1, ROUNDS + 1):
        price = np.zeros(capacity + 1)
        price[live] = share[live] * np.exp(log_weight[live] - log_weight[live].max())
        best, choice = knapsack(price, capacity)
        price, best = price / best[capacity], best / best[capacity]
        prices += price
        bound = max(bound, float(need @ price))
        grown = np.zeros(capacity + 1)
        firsts = live[price[live] + best[capacity - live] >= 1 - SLACK]
        for first in firsts[np.argsort(-log_weight[firsts], kind="stable")].tolist():
            if grown[first] >= 1:
                continue
            content = configuration(choice, first, capacity)
            times = min((1 - grown[length]) * need[length] / n for length, n in content.items())
            if times <= 0:
                continue
            for length, n in content.items():
                grown[length] += n * times / need[length]
            used[tuple(sorted(content.items(), reverse=True))] += times
        log_weight -= STEP / np.sqrt(step) * grown
        if step < check and step < ROUNDS:
            continue
        bound = max(bound, float(need @ prices) / knapsack(prices, capacity)[0][capacity])
        scale = bound / used.total()
        found, open_need = Counter({config: times * scale for config, times in used.items()}), need.copy()
        for config, times in found.items():
            for length, n in config:
                open_need[length] -= n * times
        found.update(fill(np.maximum(open_need, 0), capacity))
        cover = min(cover, found, key=Counter.total)
        if cover.total() <= bound * (1 + GAP):
            break
        prices, used, check = np.zeros(capacity + 1), Counter(), 2 * check
    return cover, bound


def rounded(program: Counter, counts: np.ndarray, capacity: int, carried: bool) -> list[tuple[Counter, int]]:
    """The program in whole bins, never beyond the pieces left; best-fit decreasing packs the rest.

    What rounding down cuts from a configuration is ``carried`` to the next one, up to a bin, or left to the rest.
    """
    left, bins, carry = counts.astype(np.int64).copy(), [], 0.0
    for config, times in sorted(program.items(), key=lambda x: (-x[0][0][0], -sum(a * b for a, b in x[0]), x[0])):
        times += carry
        n = min([int(times + 1e-9), *(int(left[length]) // k for length, k in config)])
        carry = min(times - n, 1.0) if carried else 0.0
        if n > 0:
            bins.append((Counter(dict(config)), n))
            for length, k in config:
                left[length] -= n * k
    return bins + best_fit(left, capacity)


def plan(counts: np.ndarray, capacity: int) -> list[tuple[Counter, int]]:
    """``(lengths in a bin, how many such bins)`` that hold exactly ``counts[l]`` pieces of each length.

    Full pieces are bins of their own. The program is rounded in two ways, and the plan with the fewest bins is
    taken; best-fit decreasing alone only if it needs fewer.
    """
    left = counts.astype(np.int64).copy()
    full, left[capacity] = int(left[capacity]), 0
    bins = [(Counter({capacity: 1}), full)] if full else []
    program, _ = configuration_lp(left, capacity)
    plans = [*(rounded(program, left, capacity, carried) for carried in (False, True)), best_fit(left, capacity)]
    return bins + min(plans, key=lambda x: sum(n for _, n in x))


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Counter, int]]:
    """Best-fit decreasing on counts: bins of equal content are one entry.

    Each length in turn, the longest first, goes to the bins with the least room that still take it.
    """
    bins: dict[int, Counter] = {}  # room -> contents -> how many bins
    counts = counts.copy()
    for length in range(capacity, 0, -1):
        n = int(counts[length])
        for room in sorted(r for r in bins if r >= length):
            if not n:
                break
            each = room // length
            for content in list(bins.get(room, ())):
                if not n:
                    break
                m = bins[room][content]
                full = min(m, n // each)
                moves = [(full, each)] + ([(1, n - full * each)] if full < m and 0 < n - full * each < each else [])
                for k, per in moves:
                    if not k:
                        continue
                    bins[room][content] -= k
                    bins.setdefault(room - per * length, Counter())[(*content, (length, per))] += k
                    n -= k * per
                if not bins[room][content]:
                    del bins[room][content]
        each = capacity // length
        for k, per in ((n // each, each), (1 if n % each else 0, n % each)):
            if k:
                bins.setdefault(capacity - per * length, Counter())[((length, per),)] += k
    return [(Counter(dict(content)), k) for held in bins.values() for content, k in held.items() if k]


def slots(bins: list[tuple[Counter, int]]) -> dict[int, np.ndarray]:
    """By length, rows ``(first rank, pieces in a bin, first bin, first offset)`` in the order of ranks."""
    table: dict[int, list] = {}
    used: Counter = Counter()
    base = 0
    for content, n in bins:
        offset = 0
        for length, per in sorted(content.items(), reverse=True):
            table.setdefault(length, []).append((used[length], per, base, offset))
            used[length] += n * per
            offset += length * per
        base += n
    return {length: np.array(rows, dtype=np.int64) for length, rows in table.items()}


def pack(rows: DataFrame, key: list[str], capacity: int = CAPACITY) -> DataFrame:
    """The rows with ``sequence_id`` and ``offset``; ``length`` is 1 to ``capacity``, ``key`` spreads and orders the rows.

    Give a table that is written, as it is read for its histogram, its ranks and its places. Rows of one length
    are ranked in groups of about ``RANK_ROWS``, so a length that holds a third of all rows is no single group.
    """
    spark = rows.sparkSession
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    table = spark.sparkContext.broadcast(slots(plan(counts, capacity)))
    groups = F.array(*[F.lit(max(1, -(-int(n) // RANK_ROWS))) for n in counts])
    dealt = rows.withColumn("_group", F.pmod(F.xxhash64(*key), F.get(groups, F.col("length").cast("int"))))
    sizes = dealt.groupBy("length", "_group").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("length", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = F.row_number().over(Window.partitionBy("length", "_group").orderBy(*key)) - 1
    ranked = dealt.withColumn("_rank", within).join(first, ["length", "_group"]).withColumn("_rank", F.col("_rank") + F.col("_first"))

    names = rows.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = np.array(batch.column("length")), np.array(batch.column("_rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length).tolist():
                at = np.flatnonzero(length == value)
                found = table.value[value]
                first_rank, per, base, start = found[np.searchsorted(found[:, 0], rank[at], side="right") - 1].T
                sequence[at] = base + (rank[at] - first_rank) // per
                offset[at] = start + (rank[at] - first_rank) % per * value
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", sequence_id long, offset long"
    return ranked.select(*names, "_rank").mapInArrow(place, shape)


def with_digest(rows: DataFrame) -> DataFrame:
    """``ids_crc32`` in place of ``ids``."""
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def packed_documents(docs: DataFrame, path: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents in their places, with a digest of their ids."""
    return pack(cut(with_digest(pieces(docs, path, end_id, capacity))), ["doc_id", "piece", "ids_crc32"], capacity)
