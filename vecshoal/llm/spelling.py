"""Spelling variants of a vocabulary by bidirectional search in FM-indexes.

Two words are near if one inserted, deleted or replaced character turns one into the other. One error spares the first or the second
half of a word, so each word is searched twice: its first half is matched as it is and extended to the right over the second half with one error
allowed, and its second half is matched and extended to the left.

1. Words are dealt by half: as targets under the first and last halves that words of their length, one more or one less would have, as queries
   under their own. A word with a near word thus meets it under one half at least. Halves with over ``most`` words are dealt in pieces, and their
   queries to each piece.
2. A task takes whole halves, about ``most`` words at a time, and builds the FM-index of those words between delimiters in both directions: rotations
   sorted by prefix doubling, wavelet matrices over the last columns. A state is a pair of suffix-rank intervals, of the pattern and of
   the reversed pattern; extending one by a character moves the other by the number of smaller characters. All queries are extended together.
   Rotations that begin with a delimiter rank by word, so the interval of a whole word between delimiters is its number.
3. Near words are counted and the most frequent one kept for each query; these are summed over halves and pieces. A near word with the same first
   half counts under that half only, so none counts twice.

The form of a word is its most frequent near word (ties: the smallest) if that is ``times`` as frequent as the word; its root is where the
forms lead. Frequencies grow along the way, so a path is short, and its length halves with each join.

Cases: words shorter than ``least_length`` or rarer than ``least_count`` are no words; NULL words are left out; words of any length and alphabet are
searched alike; an empty table gives an empty result. A word has one row, so rows are never repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecshoal.llm.common import kept_at
from vecshoal.session import remove_path


def rotations(text: np.ndarray) -> np.ndarray:
    """Starts of the rotations of a text in order, by prefix doubling."""
    rank = text.astype(np.int64)
    size, step = len(text), 1
    while True:
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -step)
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(size, dtype=np.int64)
        rank[order] = new
        if new[-1] == size - 1 or step >= size:
            return order
        step *= 2


class Ranks:
    """Wavelet matrix over the last column of the sorted rotations of a text, with the intervals of backward search."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = rotations(text)
        last = text[order - 1].astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(last, minlength=symbols))])
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for bit in reversed(range(self.bits)):
            set_ = last >> bit & 1
            self.ones.append(np.concatenate([[0], np.cumsum(set_, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(len(last) - int(self.ones[-1][-1]))
            last = np.concatenate([last[set_ == 0], last[set_ == 1]])
        # Where the run of a symbol begins in the last order, by reversed bits.
        self.run = np.zeros(1 << self.bits, dtype=np.int64)
        found, at = np.unique(last, return_index=True)
        self.run[found] = at

    def extend(self, low: np.ndarray, size: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and size of the interval with one more symbol, and how many smaller symbols the old one held."""
        high, less = low + size, np.zeros(len(low), dtype=np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            set_ = (symbol >> (self.bits - 1 - level) & 1).astype(bool)
            low_1, high_1 = ones[low].astype(np.int64), ones[high].astype(np.int64)
            low_0, high_0 = low - low_1, high - high_1
            less += np.where(set_, high_0 - low_0, 0)
            low, high = np.where(set_, zeros + low_1, low_0), np.where(set_, zeros + high_1, high_0)
        return self.before[symbol] + low - self.run[symbol], high - low, less

    def children(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All extensions that occur: number of the interval, symbol, new start and size, smaller symbols."""
        of, high = np.arange(len(low)), low + size
        symbol, less = np.zeros(len(low), dtype=np.int64), np.zeros(len(low), dtype=np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            low_1, high_1 = ones[low].astype(np.int64), ones[high].astype(np.int64)
            low_0, high_0 = low - low_1, high - high_1
            left, right = high_0 > low_0, high_1 > low_1
            less = np.concatenate([less[left], (less + high_0 - low_0)[right]])
            symbol = np.concatenate([symbol[left] << 1, symbol[right] << 1 | 1])
            of = np.concatenate([of[left], of[right]])
            low, high = np.concatenate([low_0[left], (zeros + low_1)[right]]), np.concatenate([high_0[left], (zeros + high_1)[right]])
        return of, symbol, self.before[symbol] + low - self.run[symbol], high - low, less


def code_points(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)


class WordIndex:
    """Both directions of the delimited text of sorted, distinct words."""

    def __init__(self, words: list[str]):
        lengths = np.array([len(word) for word in words], dtype=np.int64)
        points = np.zeros(int(lengths.sum()) + len(words), dtype=np.int64)
        inside = np.ones(len(points), dtype=bool)
        inside[np.cumsum(lengths + 1) - lengths - 1] = False
        points[inside] = code_points(words) + 1  # 0 is the delimiter, which stands before each word
        self.alphabet = np.unique(points)
        codes = np.searchsorted(self.alphabet, points)
        self.left = Ranks(codes, len(self.alphabet))
        self.right = Ranks(codes[::-1], len(self.alphabet))
        self.size = len(codes)

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words one after another, -1 for those that no indexed word has, and where each word starts."""
        points = code_points(words) + 1
        place = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        starts = np.concatenate([[0], np.cumsum([len(word) for word in words])])
        return np.where(self.alphabet[place] == points, place, -1), starts

    def near(self, words: list[str], rightwards: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of numbers of queries and indexed words one error apart, where the first half (or else the second) agrees."""
        codes, starts = self.codes(words)
        if not rightwards:
            # Leftwards everything is the mirror image: words are read from their ends, intervals change places.
            codes = codes[::-1]
            starts = (len(codes) - starts)[::-1]
        length = np.diff(starts)
        exact = length // 2 if rightwards else length - length // 2
        inward, outward = (self.left, self.right) if rightwards else (self.right, self.left)
        own, other = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        size, live = np.full(len(words), self.size), np.ones(len(words), dtype=bool)
        for step in range(int(exact.max(initial=0)) + 1):
            # The exact half from its inner end outwards, then the delimiter.
            some = np.flatnonzero(live & (step <= exact))
            symbol = np.where(step < exact[some], codes[np.minimum(starts[some] + exact[some] - 1 - step, len(codes) - 1)], 0)
            symbol[step == exact[some]] = 0
            known = symbol >= 0
            live[some[~known]] = False
            some, symbol = some[known], symbol[known]
            low, count, less = inward.extend(own[some], size[some], symbol)
            own[some], size[some], other[some] = low, count, other[some] + less
            live[some[count == 0]] = False
        q = np.flatnonzero(live)
        zero = q, exact[q], own[q], other[q], size[q]
        one = tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
        found_q, found_w = [], []

        def symbol_at(q: np.ndarray, at: np.ndarray) -> np.ndarray:
            """The query's symbol at a place, 0 beyond its end."""
            inside = at < length[q]
            return np.where(inside, codes[np.where(inside, starts[q] + at, 0)], 0) if len(codes) else np.zeros(len(q), dtype=np.int64)

        while len(zero[0]) or len(one[0]):
            # States with an error go on as the query does; the delimiter ends them.
            q, at, own, other, size = one
            symbol = symbol_at(q, at)
            q, at, own, other, size, symbol = (x[symbol >= 0] for x in (q, at, own, other, size, symbol))
            low, count, less = outward.extend(other, size, symbol)
            own = own + less
            ends = (at == length[q]) & (count > 0)
            found_q.append(q[ends])
            found_w.append(own[ends] if rightwards else low[ends])
            goes = (at < length[q]) & (count > 0)
            later = [tuple(x[goes] for x in (q, at + 1, own, low, count))]
            # States without one: an extension by the query's own symbol, or an error.
            q, at, own, other, size = zero
            wanted = symbol_at(q, at)
            inside = at < length[q]
            drop = inside & (wanted != symbol_at(q, at + 1))
            later.append(tuple(x[drop] for x in (q, at + 1, own, other, size)))
            of, symbol, low, count, less = outward.children(other, size)
            same = inside[of] & (symbol == wanted[of])
            moved = own[of] + less
            zero = tuple(x[same] for x in (q[of], at[of] + 1, moved, low, count))
            inserted = ~same & (symbol > 0)
            replaced = inserted & inside[of]
            later.append(tuple(x[inserted] for x in (q[of], at[of], moved, low, count)))
            later.append(tuple(x[replaced] for x in (q[of], at[of] + 1, moved, low, count)))
            one = tuple(np.concatenate(parts) for parts in zip(*later))
        q, w = np.concatenate([*found_q, one[0]]), np.concatenate([*found_w, one[0]])
        pairs = np.unique(q * max(self.size, 1) + w)
        q, w = pairs // max(self.size, 1), pairs % max(self.size, 1)
        return (q, w) if rightwards else (len(words) - 1 - q, w)


def dealt(words: DataFrame, least_length: int, most: int) -> DataFrame:
    """``side, half, piece, query, target, word, n``: each word under its halves, as a query under its own."""
    l = F.length("word")  # noqa: E741
    first, second = F.floor((l - 1) / 2).cast("int"), F.floor(l / 2).cast("int")
    least = least_length // 2

    def under(side: int, size: Column, own: Column) -> Column:
        text = F.substring(F.col("word"), F.lit(1) if side == 0 else l - size + 1, size)
        return F.struct(F.lit(side).alias("side"), text.alias("half"), (size == own).alias("query"), size.alias("size"))

    halves = [under(0, size, F.floor(l / 2).cast("int")) for size in (first, first + 1)]
    halves += [under(1, size, F.ceil(l / 2).cast("int")) for size in (second, second + 1)]
    rows = words.select("word", "n", F.explode(F.array(*halves)).alias("x")).select("word", "n", "x.*").where(F.col("size") >= least).drop("size")
    counts = rows.groupBy("side", "half").agg(F.count("*").alias("members"), F.max("query").alias("asked")).where("members > 1 and asked")
    rows = rows.join(counts.drop("asked"), ["side", "half"])
    pieces = F.ceil(F.col("members") / most).cast("int")
    own = F.pmod(F.xxhash64("word"), pieces).cast("int")
    every = F.when(F.col("query"), F.sequence(F.lit(0), pieces - 1)).otherwise(F.array(own))
    rows = rows.withColumn("own", own).withColumn("piece", F.explode(every))
    return rows.select("side", "half", "piece", "query", (F.col("piece") == F.col("own")).alias("target"), "word", "n")


def near_words(words: DataFrame, least_length: int, most: int) -> DataFrame:
    """``word, n_near, best``: the number of near words of each word that has any, and the negative count and text of the most frequent."""

    def found(bucket: np.ndarray, side: np.ndarray, query: np.ndarray, target: np.ndarray, word: list[str], n: np.ndarray) -> pa.RecordBatch:
        counts = {word[i]: int(n[i]) for i in np.flatnonzero(target)}
        indexed = sorted(counts)
        number = {w: i for i, w in enumerate(indexed)}
        index = WordIndex(indexed)
        member = np.sort([int(bucket[i]) * len(indexed) + number[word[i]] for i in np.flatnonzero(target)])
        best: dict[str, list] = {}
        for of in (0, 1):
            asked = np.flatnonzero(query & (side == of))
            for begin in range(0, len(asked), 20_000):
                some = asked[begin : begin + 20_000]
                q, w = index.near([word[i] for i in some], rightwards=of == 0)
                code = bucket[some[q]] * len(indexed) + w
                place = np.minimum(np.searchsorted(member, code), len(member) - 1)
                for i, j in zip(*(x[member[place] == code].tolist() for x in (q, w))):
                    asking, near = word[some[i]], indexed[j]
                    if of == 1 and near.startswith(asking[: len(asking) // 2]):
                        continue  # found under the first half
                    entry = best.setdefault(asking, [0, (0, "")])
                    entry[0] += 1
                    entry[1] = min(entry[1], (-counts[near], near)) if entry[0] > 1 else (-counts[near], near)
        columns = [list(best), [e[0] for e in best.values()], [e[1][0] for e in best.values()], [e[1][1] for e in best.values()]]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=["word", "n_near", "least", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def flushed(whole_groups: bool) -> Iterator[pa.RecordBatch]:
            """Answers the groups held, all or all but the last; the targets of the last stay, as its queries may go on."""
            nonlocal held, rows
            table = pa.Table.from_batches(held).combine_chunks()
            keys = [table[name].combine_chunks().dictionary_encode().indices.to_numpy() if name == "half" else table[name].to_numpy() for name in ("side", "half", "piece")]
            change = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            bucket = np.concatenate([[0], np.cumsum(change)])
            query, target = (table[name].to_numpy(zero_copy_only=False) for name in ("query", "target"))
            cut = len(bucket) if whole_groups else int(np.searchsorted(bucket, bucket[-1]))
            if cut == 0:
                cut = len(bucket)  # one group so far, targets first: answer the queries there are
                kept = table.filter(pa.array(target)).set_column(3, "query", pa.array(np.zeros(int(target.sum()), dtype=bool)))
                if not query.any():
                    return
            else:
                kept = table.slice(cut)
            part = table.slice(0, cut)
            yield found(bucket[:cut], part["side"].to_numpy(), query[:cut], target[:cut], part["word"].to_pylist(), part["n"].to_numpy())
            held = kept.to_batches()
            rows = 0

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows > 2 * most:
                yield from flushed(whole_groups=False)
        if any(batch.num_rows for batch in held):
            yield from flushed(whole_groups=True)

    keys = ["side", "half", "piece"]
    by_half = dealt(words, least_length, most).repartition(*keys).sortWithinPartitions(*keys, F.col("target").desc(), "word")
    found_rows = by_half.select("side", "half", "piece", "query", "target", "word", "n").mapInArrow(run, "word string, n_near long, least long, near string")
    return found_rows.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("least", "near")).alias("best"))


def follow(forms: DataFrame) -> tuple[DataFrame, str]:
    """``word, root`` where the forms of ``word, form`` lead; every join doubles the steps that a row has gone."""
    roots, path = kept_at(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went"))
        after, after_path = kept_at(joined, "roots")
        remove_path(forms.sparkSession, path)
        roots, path = after.drop("went"), after_path
        if after.where("went").isEmpty():
            return roots, path


def group_variants(
    words: DataFrame, word: str = "word", least_length: int = 6, least_count: int = 5, times: int = 5, most: int = 50_000
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the vocabulary that the rows of ``words`` make."""
    rows = words.select(F.col(word).alias("word")).where(F.length("word") >= least_length)
    counted = rows.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)
    vocabulary, _ = kept_at(counted, "vocabulary")
    near, near_path = kept_at(near_words(vocabulary, least_length, most), "near-words")
    best_n = -F.col("best.least")
    taken = best_n >= times * F.col("n")
    joined = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(taken, F.col("best.near")).alias("form"), F.when(taken, best_n).alias("form_n")
    )
    formed, _ = kept_at(joined, "forms")
    remove_path(words.sparkSession, near_path)
    roots, _ = follow(formed.where(F.col("form").isNotNull()))
    out = formed.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
