"""Operator 5, byte-level BPE encoding and decoding by speculation and verification.

Texts are cut into words by the tokenizer's own pattern.  For the distinct words of a batch that are not known yet,
greedy longest match proposes tokens; a sequence of tokens is the BPE encoding of its bytes exactly when every
adjacent pair is (merging the bytes of the pair gives back the pair), so the distinct pairs of all proposals are tested at
once in numpy, and only words with a failing pair are merged exactly.

Defined cases: a null or empty text has no ids and decodes to the empty text; the tokenizer's added tokens inside a
text become their own ids, as the tokenizers library does by default; other columns pass through untouched (the
result columns replace any of the same name); repeated rows are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import pre_tokenizers

from .shared import chunks, table

#: The pre-tokenisation pattern of byte-level BPE, with white space as Unicode defines it (fixed value).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")

#: Blocks in which Unicode versions disagree about letters and numbers.  Texts with such a character are cut by the
#: tokenizers library's own pre-tokenizer, whatever version it was built with.
UNSETTLED = regex.compile("[\u0530-\u10ff\u1c80-\u1cff\u2080-\u209f\ua640-\uabff\U00010000-\U0010ffff]")

#: Words whose encoding a task remembers; more are forgotten and encoded again.
KNOWN_WORDS = 300_000
#: Longer words are merged one by one with a queue.
LONG_WORD = 64


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable Latin-1 bytes stand for themselves, the rest follow 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        letters = byte_letters()
        raw = {token: bytes(letters[c] for c in token) for token in spec["model"]["vocab"]}
        ids = spec["model"]["vocab"]
        self.ids = {raw[token]: i for token, i in ids.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = [b""] * (1 + max([*ids.values(), *self.added.values()]))
        for token, i in ids.items():
            self.bytes[i] = raw[token]
        for content, i in self.added.items():
            self.bytes[i] = content.encode()
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left, right, made = (np.array(x, np.int64) for x in zip(*((ids[a], ids[b], ids[a + b]) for a, b in merges), strict=True))
        self.made = made
        self.codes, self.ranks = (left << 32) + right, np.arange(len(merges))
        order = np.argsort(self.codes)
        self.codes, self.ranks = self.codes[order], order
        # Of each token when it is made (bytes: before all) and of which two tokens.
        self.formed = np.full(len(self.bytes), -1, np.int64)
        self.formed[made] = np.arange(len(merges))
        self.left, self.right = np.zeros((2, len(self.bytes)), np.int64)
        self.left[made], self.right[made] = left, right
        if len(np.unique(made)) < len(made) or (np.maximum(self.formed[left], self.formed[right]) >= np.arange(len(made))).any():
            raise ValueError(f"{path}: a token must come from one merge, made after its parts")
        self.merges = {(a, b): (rank, c) for rank, (a, b, c) in enumerate(zip(left.tolist(), right.tolist(), made.tolist(), strict=True))}
        self.single = np.array([self.ids[bytes([b])] for b in range(256)])
        self.reach: dict[bytes, int] = {}  # of each four bytes the length of the longest token that starts with them
        for token in self.ids:
            if len(token) > 3:
                self.reach[token[:4]] = max(self.reach.get(token[:4], 3), len(token))
        self.find = regex.compile(PATTERN).findall
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.letters = letters
        self.cuts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.known: dict[str, bytes] = {}
        self.sound = np.zeros(len(self.bytes), bool)  # tokens whose bytes are merged back to them
        tokens = list(ids.values())
        flat, lengths = self.merge_all([self.bytes[i] for i in tokens])
        ones = lengths == 1
        self.sound[np.array(tokens)[ones]] = flat[(np.cumsum(lengths) - 1)[ones]] == np.array(tokens)[ones]

    def words(self, text: str) -> list[str]:
        if not UNSETTLED.search(text):
            return self.find(text)
        return [bytes(self.letters[c] for c in w).decode() for w, _ in self.library.pre_tokenize_str(text)]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; beyond all ranks where there is none."""
        code = (a << 32) + b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.ranks[at], len(self.codes))

    def merge(self, data: bytes) -> list[int]:
        """Exact BPE of one long word: the lowest-ranked adjacent pair first, the leftmost of equals."""
        ids = self.single[np.frombuffer(data, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        queue = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(len(ids) - 1)
                 if (m := self.merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, a, b, new = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < len(ids):
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < len(ids) and (m := self.merges.get((ids[left], ids[right]))):
                    heapq.heappush(queue, (m[0], left, ids[left], ids[right], m[1]))
        return [i for i in ids if i >= 0]

    def merge_all(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact BPE of many words at once, a merge in every word a round; their ids in a row and how many each has."""
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        long = np.flatnonzero(sizes > LONG_WORD)
        done_word, done_ids = [], []
        for w in long:
            merged = self.merge(data[w])
            done_word.append(np.full(len(merged), w))
            done_ids.append(np.array(merged))
        short = np.flatnonzero(sizes <= LONG_WORD)
        ids = self.single[np.frombuffer(b"".join(data[w] for w in short), np.uint8)]
        word = np.repeat(short, sizes[short])
        none = len(self.codes)
        while len(ids):
            rank = np.full(len(ids), none)
            same = np.flatnonzero(word[1:] == word[:-1])
            rank[same] = self.rank(ids[same], ids[same + 1])
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.r_[starts, len(ids)])
            live = np.repeat(best < none, counts)
            if not live.all():
                done_word.append(word[~live])
                done_ids.append(ids[~live])
            at = np.flatnonzero(live & (rank == np.repeat(best, counts)))
            at = at[np.r_[True, word[at[1:]] != word[at[:-1]]]] if len(at) else at
            ids[at] = self.made[rank[at]]
            live[at + 1] = False
            ids, word = ids[live], word[live]
        word = np.concatenate([np.zeros(0, np.int64), *done_word])
        order = np.argsort(word, kind="stable")
        return np.concatenate([np.zeros(0, np.int64), *done_ids])[order], np.bincount(word, minlength=len(data))

    def propose(self, data: bytes) -> list[int]:
        """Greedy longest match."""
        out, at, ids, reach, n = [], 0, self.ids, self.reach, len(data)
        while at < n:
            end = at + reach.get(data[at:at + 4], 3)
            while (token := ids.get(data[at:end])) is None:
                end -= 1
            out.append(token)
            at = min(end, n)
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of each pair a, b keeps the border between them.

        Going back in time from the finished pair, x is the token left of the border and y the one right of it, each
        until it is merged further.  The border falls if x and y merge before either does so (of equal
        ranks the leftmost merge goes first).
        """
        x, y = a.copy(), b.copy()
        x_ends = y_ends = np.full(len(a), len(self.codes))
        holds = self.sound[a] & self.sound[b]
        while True:
            rank = self.rank(x, y)
            holds &= ~((rank < x_ends) & (rank <= y_ends) & (rank < len(self.codes)))
            made_x, made_y = self.formed[x], self.formed[y]
            if not ((made_x >= 0) | (made_y >= 0)).any():
                return holds
            split_x = made_x > made_y
            split_y = ~split_x & (made_y >= 0)
            x_ends, y_ends = np.where(split_x, made_x, x_ends), np.where(split_y, made_y, y_ends)
            x, y = np.where(split_x, self.right[x], x), np.where(split_y, self.left[y], y)

    def learn(self, fresh: list[str]) -> None:
        """Encode new words and remember them as little-endian 32-bit ids."""
        if not fresh:
            return
        data = [w.encode() for w in fresh]
        proposed = list(map(self.propose, data))
        lengths = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(lengths.sum()))
        word = np.repeat(np.arange(len(fresh)), lengths)
        same = np.flatnonzero(word[1:] == word[:-1])
        pairs, which = np.unique((flat[same] << 32) + flat[same + 1], return_inverse=True)
        bad = np.zeros(len(fresh), bool)
        bad[word[same[~self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[which]]]] = True
        bad[word[~self.sound[flat]]] = True
        good = ~bad
        exact, exact_lengths = self.merge_all([data[i] for i in np.flatnonzero(bad)])
        for words, ids, sizes in ((np.flatnonzero(good), flat[good[word]], lengths[good]),
                                  (np.flatnonzero(bad), exact, exact_lengths)):
            raw, at = ids.astype("<u4").tobytes(), 0
            for w, end in zip(words.tolist(), (4 * np.cumsum(sizes)).tolist(), strict=True):
                self.known[fresh[w]] = raw[at:end]
                at = end

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        pieces = []
        for text in texts:
            if not text:
                pieces.append([])
            elif any(a in text for a in self.added):
                pieces.append([self.added[p] if p in self.added else self.words(p) for p in self.cuts.split(text) if p])
            else:
                pieces.append([self.words(text)])
        seen = set().union(*(p for doc in pieces for p in doc if not isinstance(p, int)))
        fresh = [w for w in seen if w not in self.known]
        if len(self.known) + len(fresh) > KNOWN_WORDS:  # keep those of this batch, among which the frequent are
            self.known = {w: self.known[w] for w in seen if w in self.known}
        self.learn(fresh)
        get = self.known.__getitem__
        return [b"".join(p.to_bytes(4, "little") if isinstance(p, int) else b"".join(map(get, p)) for p in doc)
                for doc in pieces]

    def decode(self, ids: bytes) -> str:
        get = self.bytes.__getitem__
        return b"".join(map(get, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def model(path: str) -> ByteBPE:
    return ByteBPE(path)


def _with(df: DataFrame, fields: list[T.StructField]) -> T.StructType:
    names = {f.name for f in fields}
    return T.StructType([f for f in df.schema.fields if f.name not in names] + fields)


def encode_decode(docs: DataFrame, path: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Return ``keep`` (all columns) of ``docs`` with ``ids`` (binary, 32-bit little-endian) and ``decoded`` (string)."""
    path = path or default_path()
    kept = [c for c in (keep if keep is not None else docs.columns) if c not in ("ids", "decoded")]
    source = docs.select(*kept, *([] if "text" in kept else ["text"]))
    schema = _with(source.select(*kept), [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for batch in chunks(batches, "text"):
            ids = bpe.encode(batch.column("text").to_pylist())
            decoded = [bpe.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                names=[*kept, "ids", "decoded"])

    return source.mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    return encode_decode(docs, keep=["doc_id"]).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def query(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
