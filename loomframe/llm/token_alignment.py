"""Alignment of two tokenizers over a corpus: groups of tokens between shared ends, links by overlap, corpus-wide counts of linked pairs.

Most groups are one token on either side with the same bytes. A map from A's ids to such ids of B is made beforehand, and
these links are counted in vectors as long as A's vocabulary; only the others are shuffled as pairs.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Distinct stretches of text that a worker remembers before it starts anew, and bytes of text aligned at once; both bound its memory.
MEMO, PORTION = 500_000, 1 << 20
#: Pairs whose counts are sent to every task: those with more than a HOT-th of all counted pairs, so fewer than HOT.
HOT = 50_000


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with: printable ones stand for themselves, the rest follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Pair:
    """Both tokenizers, the bytes of their ids, and the map from A's ids to B's ids of the same bytes (-1: none)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.bytes_b, same = [], {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
            # a piece goes before the fallback byte that says the same
            if not self.b.is_control(i) and not self.b.is_unknown(i) and (self.bytes_b[i] not in same or self.b.is_byte(same[self.bytes_b[i]])):
                same[self.bytes_b[i]] = i
        self.same = np.array([same.get(x, -1) for x in self.bytes_a], np.int64)
        self.n_a, self.n_b = len(self.bytes_a), len(self.bytes_b)
        self.space = self.b.piece_to_id("▁")
        pieces = (self.b.id_to_piece(i) for i in range(self.n_b) if not self.b.is_byte(i))
        #: No piece reaches over the start of a word or over a line feed, so text may be cut there.
        self.cuts = not any(re.search("[^▁]▁|\n", p) for p in pieces)

    def stretches(self, text: str) -> list[str]:
        """Space and text, cut where neither tokenizer's tokens can reach over: before a space, or a line feed, that follows something else than white space."""
        if not self.cuts:
            return [" " + text]
        out: list[str] = []
        for word in text.split(" "):
            parts = [" " + word]
            if "\n" in word:
                first, *rest = word.split("\n")
                parts = [" " + first]
                for line in rest:
                    # the line feed must stand between two characters that aren't white space
                    if line and not line[0].isspace() and not parts[-1][-1].isspace():
                        parts.append("\n" + line)
                    else:
                        parts[-1] += "\n" + line
            if out and out[-1][-1].isspace():
                out[-1] += parts[0]
                del parts[0]
            out += parts
        return out

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Token ids of stretches, each of which starts with the space that B adds, or with a line feed."""
        a = [e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        b = self.b.encode([s[1:] if s[0] == " " else s for s in parts], num_threads=1)
        for i, s in enumerate(parts):
            if s[0] != " ":
                if b[i][0] != self.space:
                    raise ValueError("the second tokenizer adds no space of its own")
                del b[i][0]
        return a, b


@cache
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


class Known:
    """What is known of stretches: sizes (A tokens, B tokens, groups, links), groups as text, and links, one after the other.

    Links of the identity map are held as -1 - A id, others as A id * ids of B + B id.
    """

    def __init__(self, tokens: Pair):
        self.tokens = tokens
        # a number's decimal digits, left aligned, with room for a separator
        top = max(tokens.n_a, tokens.n_b)
        text = [str(i).encode() for i in range(top)]
        self.width = max(map(len, text))
        self.digits = np.frombuffer(b"".join(t.ljust(self.width + 1) for t in text), np.uint8).reshape(top, self.width + 1)
        self.n_digits = np.array([len(t) for t in text])
        self.len_a, self.len_b = (np.array([len(x) for x in y]) for y in (tokens.bytes_a, tokens.bytes_b))
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.sizes, self.bad, self.links, self.ends = np.zeros((0, 4), np.int64), np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def learn(self, parts: list[str]) -> None:
        """Take in new stretches, numbered in their order."""
        sizes, bad, groups, links, ends = self.measure(parts)
        self.groups += groups
        self.sizes, self.bad = np.concatenate([self.sizes, sizes]), np.concatenate([self.bad, bad])
        self.links, self.ends = np.concatenate([self.links, links]), np.concatenate([self.ends, self.ends[-1] + ends[1:]])

    def measure(self, parts: list[str]):
        """Sizes, whether the bytes come out differently (then all else is empty), groups each with `;` behind, and links with their bounds."""
        ids_a, ids_b = self.tokens.encode(parts)
        data = [p.encode("utf-8", "surrogatepass") for p in parts]
        bad = np.array([self._differs(d, a, b) for d, a, b in zip(data, ids_a, ids_b)], bool)
        for i in np.flatnonzero(bad):
            ids_a[i], ids_b[i] = [], []
        n = len(parts)
        n_a, n_b = np.array([len(x) for x in ids_a], np.int64), np.array([len(x) for x in ids_b], np.int64)
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, int(k.sum())) for x, k in ((ids_a, n_a), (ids_b, n_b)))
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        # every stretch between neighbouring ends of either lies in one token of both: a link
        end = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, end), np.searchsorted(end_b, end)
        x, y = a[at_a], b[at_b]
        links = np.where(self.tokens.same[x] == y, -1 - x, x * self.tokens.n_b + y)
        owner = np.repeat(np.arange(n), n_a)
        n_links = np.bincount(owner[at_a], minlength=n)
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        n_groups = np.bincount(owner[np.searchsorted(end_a, shared)], minlength=n)
        # tokens in the order in which they are written: by group, A's before B's
        side = np.concatenate([np.searchsorted(shared, end_a) * 2, np.searchsorted(shared, end_b) * 2 + 1])
        order = np.argsort(side, kind="stable")
        side, token, of = side[order], np.concatenate([a, b])[order], np.concatenate([owner, np.repeat(np.arange(n), n_b)])[order]
        rows = self.digits[token]
        last = np.append(side[1:] != side[:-1], True)[: len(side)]
        rows[np.arange(len(rows)), self.n_digits[token]] = np.where(last, np.where(side & 1, ord(";"), ord("|")), ord(","))
        text = rows[np.arange(self.width + 1) <= self.n_digits[token][:, None]].tobytes()
        cut = np.concatenate([[0], np.cumsum(np.bincount(of, self.n_digits[token] + 1, n)).astype(np.int64)]).tolist()
        groups = [text[p:q] for p, q in zip(cut[:-1], cut[1:])]
        return np.stack([n_a, n_b, n_groups, n_links], 1), bad, groups, links, np.concatenate([[0], np.cumsum(n_links)])

    def _differs(self, data: bytes, a: list[int], b: list[int]) -> bool:
        return b"".join(map(self.tokens.bytes_a.__getitem__, a)) != data or b"".join(map(self.tokens.bytes_b.__getitem__, b)) != data

    def documents(self, texts: list[str | None]):
        """For some texts: sizes, digests, and distinct links as (text, link, times) in order of text and link."""
        if len(self.number) > MEMO:
            self.clear()
        number, at, lengths, new = self.number, [], [], []
        for text in texts:
            cuts = self.tokens.stretches(text) if text else []
            lengths.append(len(cuts))
            for s in cuts:
                i = number.get(s)
                if i is None:
                    i = number[s] = len(number)
                    new.append(s)
                at.append(i)
        if new:
            self.learn(new)
        n = len(texts)
        at, doc = np.array(at, np.int64), np.repeat(np.arange(n), lengths)
        # where a stretch's bytes come out differently only the whole text can tell
        odd = np.bincount(doc, self.bad[at], n) > 0
        bounds = np.concatenate([[0], np.cumsum(lengths)]).tolist()
        digests = ["" if not lengths[d] or odd[d] else _sha(map(self.groups.__getitem__, at[p:q].tolist())) for d, (p, q) in enumerate(zip(bounds[:-1], bounds[1:]))]
        keep = ~odd[doc]
        at, doc = at[keep], doc[keep]
        sizes = np.stack([np.bincount(doc, self.sizes[at, k], n) for k in range(4)], 1).astype(np.int64)
        once, times = np.unique(doc << 32 | at, return_counts=True)
        doc, at = once >> 32, once & 0xFFFFFFFF
        many = self.ends[at + 1] - self.ends[at]
        inside = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        found = [(np.repeat(doc, many), self.links[np.repeat(self.ends[at], many) + inside], np.repeat(times, many))]
        for d in np.flatnonzero(odd).tolist():
            size, bad, groups, links, _ = self.measure([" " + texts[d]])
            if not bad[0]:
                sizes[d], digests[d] = size[0], _sha(groups)
                found.append((np.full(len(links), d), links, np.ones(len(links), np.int64)))
        doc, link, times = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((link, doc))
        doc, link, times = doc[order], link[order], times[order]
        first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (link[1:] != link[:-1]))[: len(doc)])
        return sizes, digests, doc[first], link[first], np.add.reduceat(times, first) if len(first) else times


def _sha(groups) -> str:
    return hashlib.sha256(b"".join(groups)[:-1]).hexdigest()


@cache
def known(path_a: str, path_b: str) -> Known:
    """One for each Python worker, over all its tasks."""
    return Known(pair(path_a, path_b))


TOKENS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, same array<int>, same_n array<int>, pair array<long>, pair_n array<int>"


def lists(values: np.ndarray, owner: np.ndarray, n: int, kind=pa.int64()) -> pa.Array:
    """A list for each of n rows, from values in the order of their rows."""
    at = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, kind))


def tokens(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Each document's numbers of tokens, groups and links, and its distinct links with how often each comes."""

    def align(batches):
        memory = known(path_a, path_b)
        for batch in batches:
            for part in portions(batch):
                n = part.num_rows
                sizes, digests, doc, link, times = memory.documents(common.column(part, "text").to_pylist())
                is_same = link < 0
                links = []
                for some, keys, kind in ((np.flatnonzero(is_same)[::-1], -1 - link, pa.int32()), (np.flatnonzero(~is_same), link, pa.int64())):
                    some = some[np.argsort(doc[some], kind="stable")]
                    links += [lists(keys[some], doc[some], n, kind), lists(times[some], doc[some], n, pa.int32())]
                numbers = [pa.array(sizes[:, k]) for k in range(4)]
                yield pa.RecordBatch.from_arrays([common.column(part, "row"), common.column(part, "doc_id"), *numbers, pa.array(digests, pa.string()), *links], [c.split()[0] for c in TOKENS.split(", ")])

    common.small_batches(docs.sparkSession)
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(align, TOKENS)


def portions(batch: pa.RecordBatch):
    """Slices of a batch with about PORTION bytes of text, or one row where that is longer."""
    size = np.cumsum([len(t) for t in common.texts(batch)])
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(size, (size[at - 1] if at else 0) + PORTION, side="right"))
        yield batch.slice(at, max(1, upto - at))
        at = max(at + 1, upto)


def same_counts(found: DataFrame, n_a: int) -> np.ndarray:
    """Documents that hold each of the identity map's links, by A id: a task adds up a vector and sends what isn't zero."""

    def count(batches):
        total = np.zeros(n_a, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=n_a)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["a", "n"])

    out = np.zeros(n_a, np.int64)
    # a row an id: the vocabulary bounds what the driver gets
    for r in found.select("same").mapInArrow(count, "a long, n long").groupBy("a").agg(F.sum("n").alias("n")).collect():
        out[r.a] = r.n
    return out


def align(docs: DataFrame, path_a: str, path_b: str, hot: int = HOT) -> DataFrame:
    """How two tokenizers cut each document, and how usual its links are in the corpus.

    docs: doc_id and text; other columns do not pass. path_a: a byte-level BPE for the library `tokenizers`; path_b: a
    model for `sentencepiece` that puts a space before a text. Returns per row doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, all long, and groups_sha256. Tokens of A and B over space and text are grouped between the offsets where
    both end; overlapping ones are linked. A pair's count is the number of rows that hold it linked. n_best are the row's
    links whose count no other pair of their A id exceeds, count_sum the sum of its links' counts. Null and empty texts,
    and those whose tokens don't give back their bytes, have zeros and an empty digest, and count for nothing. Each row is
    a document, also where rows repeat; a null doc_id stays null. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    tables = common.Tables(spark)
    found = tables.write(tokens(docs, path_a, path_b))
    both = pair(path_a, path_b)
    n_b = both.n_b
    same = same_counts(found, both.n_a)
    counts = tables.write(found.select(F.explode("pair").alias("pair")).groupBy("pair").agg(F.count("*").alias("count")))
    # the highest count of each A id: a row an id again
    best = same.copy()
    for r in counts.groupBy(F.floor(F.col("pair") / n_b).alias("a")).agg(F.max("count").alias("n")).collect():
        best[r.a] = max(best[r.a], r.n)
    total = counts.agg(F.sum("count")).first()[0] or 0
    often = counts.where(F.col("count") * hot > total).sort("pair").toPandas()
    hot_pairs, hot_counts = often["pair"].to_numpy(np.int64), often["count"].to_numpy(np.int64)
    sent = spark.sparkContext.broadcast((same, best, hot_pairs, hot_counts))

    def score(batches):
        same, best, hot_pairs, hot_counts = sent.value
        for batch in batches:
            n = batch.num_rows
            get = lambda c: common.column(batch, c)
            of = lambda c: np.repeat(np.arange(n), get(c).value_lengths().to_numpy())
            flat = lambda c: get(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            a, times, who = flat("same"), flat("same_n"), of("same")
            key, key_times, key_who = flat("pair"), flat("pair_n"), of("pair")
            at = np.searchsorted(hot_pairs, key)
            at[at == len(hot_pairs)] = 0
            known = hot_pairs[at] == key if len(hot_pairs) else np.zeros(len(key), bool)
            count = np.concatenate([same[a], hot_counts[at[known]] if len(hot_pairs) else key[:0]])
            token = np.concatenate([a, key[known] // n_b])
            times, who = np.concatenate([times, key_times[known]]), np.concatenate([who, key_who[known]])
            total, first = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(total, who, count * times)
            np.add.at(first, who, np.where(count == best[token], times, 0))
            left = [lists(x, key_who[~known], n) for x in (key[~known], key_times[~known], best[key[~known] // n_b])]
            columns = [get(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(first), pa.array(total), *left], [c.split()[0] for c in SCORED.split(", ")])

    scored = tables.write(found.mapInArrow(score, SCORED))
    # pairs that are rarer than a HOT-th of all: no key of this join is large
    rare = scored.where(F.size("pair") > 0).select("row", F.explode(F.arrays_zip("pair", "times", "best")).alias("x")).select("row", "x.*")
    rare = rare.join(counts, "pair").groupBy("row").agg(F.sum(F.when(F.col("count") == F.col("best"), F.col("times")).otherwise(0)).alias("__best"), F.sum(F.col("count") * F.col("times")).alias("__sum"))
    out = scored.drop("pair", "times", "best").join(rare, "row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("__best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("__sum", F.lit(0))).alias("count_sum"), "groups_sha256")


SCORED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, pair array<long>, times array<long>, best array<long>"
