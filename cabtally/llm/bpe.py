"""BPE encoding by depth-first traversal of a trie of words, and decoding.

The last token of every prefix of a word fixes the word's encoding: the encoding of a
prefix is that of the prefix without its last token, followed by that token. And the last
token of a prefix is the one suffix of it that is a token and may follow the last token of
what stands before it, where v may follow u if merging the bytes of u and v gives u, v
again. So each new byte costs a few look-ups, and words that begin alike share the work
for what they share: distinct words, sorted, are a depth-first traversal of their trie,
whose stack holds the last token of each prefix on the way.

Words repeat across documents, so a worker keeps the encodings it has found, up to a
bound beyond which it starts anew; that bounds memory, and no result depends on it.
Documents go through on their own, with no shuffle at all.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ArrayType,
    DataType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from cabtally.llm.common import freeing, table

TOKENIZER = "byte_bpe_50k.json"
#: Bytes of encodings that a worker keeps, about, and pairs of tokens that it knows about.
KEPT_BYTES = 96 << 20
#: The same where workers have nothing else to keep.
ALONE_BYTES = 256 << 20
KEPT_PAIRS = 250_000
#: Words whose encodings are looked up together.
TOGETHER = 100_000
#: Bytes of texts that a task holds the ids of.
BATCH_BYTES = 4 << 20
#: Code points of a text that are split into words at once, cut where a word begins.
PIECE = 1 << 20

#: Fixed value: the pattern of byte-level BPE that tells words apart.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: visible Latin-1 letters
    for themselves, the others from U+0100 on in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Bpe:
    """Byte-level BPE of a vocabulary in the format of the tokenizers library."""

    def __init__(self, path: str, kept_bytes: int | None = None):
        self._kept_bytes = kept_bytes
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, letters = described["model"], byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        self.ids = {raw(token): i for token, i in model["vocab"].items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._ranks = {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.bytes_of = {i: token for token, i in self.ids.items()}
        self._added = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.bytes_of |= {i: content.encode() for content, i in self._added.items()}
        special = sorted(self._added, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self._words = regex.compile(PATTERN)
        self._longest = max(map(len, self.ids))
        #: The last merge that made a token.
        self._made: dict[bytes, tuple[bytes, bytes]] = {}
        #: Tokens that their own bytes are encoded as; no others occur in an encoding.
        self._own = {token for token in self.ids if self._merge(token, self._made) == [token]}
        self._made = {token: self._made[token] for token in self._own if len(token) > 1}
        self._made_at = {token: -1 for token in self._own} | {t: self._ranks[m] for t, m in self._made.items()}
        #: Whether parts are always made before what is made of them.
        self._in_order = all(
            self._made_at.get(part, rank) < rank
            for token, rank in self._made_at.items() if rank >= 0
            for part in self._made[token]
        )
        self._names = {token: str(i) for token, i in self.ids.items()}
        self._written = {str(i): token for i, token in self.bytes_of.items()}
        self._follows: dict[tuple[bytes, bytes], bool] = {}
        self._known: dict[str, str] = {}
        self._bytes = 0

    def _merge(self, word: bytes, made: dict[bytes, tuple[bytes, bytes]] | None = None) -> list[bytes]:
        """Plain BPE: the pair of the lowest rank merges first, the leftmost of equals. What
        the whole word is merged from goes to ``made``."""
        parts = [word[i : i + 1] for i in range(len(word))]
        ranks = self._ranks
        while len(parts) > 1:
            best = min(
                ((ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks),  # noqa: B905
                default=None,
            )
            if best is None:
                break
            i = best[1]
            if made is not None and len(parts) == 2:
                made[word] = (parts[0], parts[1])
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _may_follow(self, pair: tuple[bytes, bytes]) -> bool:
        if len(self._follows) >= KEPT_PAIRS:
            self._follows.clear()
        found = self._follows[pair] = self._stays(*pair)
        return found

    def _stays(self, u: bytes, v: bytes) -> bool:
        """Whether merging the bytes of the tokens u and v gives u, v: going back through the
        merges that made them, the last one first, no merge across their border came before
        the one that was undone. Of equal merges the left one came first."""
        if not self._in_order:
            return self._merge(u + v) == [u, v]
        ranks, made, at, limit = self._ranks, self._made, self._made_at, len(self._ranks)
        while ranks.get((u, v), limit) >= limit:
            of_u, of_v = at[u], at[v]
            if of_u > of_v:
                limit, u = of_u, made[u][1]
            elif of_v >= 0:
                limit, v = of_v + 1, made[v][0]
            else:
                return True
        return False

    def encode_words(self, words: Iterable[str]) -> None:
        """Traverse the trie of the ``words`` and keep their encodings."""
        last: list[bytes] = [b""]  # the stack: last token of each prefix of the word before
        before, own, known, names = b"", self._own, self._known, self._names
        fitting, longest = self._follows.get, self._longest
        for word in sorted({w.encode("utf-8", "surrogatepass") for w in words}):
            shared = 0
            for old, new in zip(before, word):  # noqa: B905
                if old != new:
                    break
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for start in range(end - longest if end > longest else 0, end):
                    token = word[start:end]
                    if token in own:
                        if start:
                            pair = (last[start], token)
                            fits = fitting(pair)
                            if fits is None:
                                fits = self._may_follow(pair)
                            if not fits:
                                continue
                        last.append(token)
                        break
            before, ids, end = word, [], len(word)
            while end:
                token = last[end]
                ids.append(names[token])
                end -= len(token)
            ids.reverse()
            joined = ",".join(ids)
            known[word.decode("utf-8", "surrogatepass")] = joined
            # Two strings and their place in the dictionary.
            self._bytes += 230 + 2 * len(word) + len(joined)

    def _pieces(self, text: str) -> Iterator[tuple[bool, list[str]]]:
        """Lists of words, and added tokens; true marks the latter."""
        parts = self._special.split(text) if self._special else [text]
        for i, part in enumerate(parts):
            if i % 2:
                yield True, [part]
                continue
            while len(part) > PIECE:
                found = self._words.findall(part[:PIECE])
                # What the cut may have changed: the last words, and white space before them.
                whole = found[:-3]
                if not whole:
                    break
                yield False, whole
                part = part[sum(map(len, whole)) :]
            if part:
                yield False, self._words.findall(part)

    def _encodings(self, texts: Iterable[str]) -> Iterator[tuple[int, str]]:
        """``(number of the text, ids)`` of each piece of the texts, ids joined by commas.
        Pieces are gathered up to a bound, so that their words share one trie."""
        pieces: list[tuple[int, bool, list[str]]] = []
        size = 0

        def known() -> Iterator[tuple[int, str]]:
            self._learn({w for _, added, words in pieces if not added for w in words})
            ids = self._known
            for number, added, words in pieces:
                yield number, str(self._added[words[0]]) if added else ",".join([ids[w] for w in words])

        for number, text in enumerate(texts):
            for added, words in self._pieces(text):
                pieces.append((number, added, words))
                size += len(words)
                if size > TOGETHER:
                    yield from known()
                    pieces, size = [], 0
        yield from known()

    def _learn(self, words: set[str]) -> None:
        missing = words.difference(self._known)
        if self._bytes > (self._kept_bytes or KEPT_BYTES):
            self._known.clear()
            self._bytes, missing = 0, words
        self.encode_words(missing)

    def forget(self) -> None:
        """Free what has been learnt, for a worker that goes on with other work."""
        self._known.clear()
        self._follows.clear()
        self._bytes = 0

    def encode_batch(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For each text how many ids, the digest of the ids, and the digest of the text
        decoded from them."""
        counts, ids, decoded = [0] * len(texts), [], []
        for _ in texts:
            ids.append(hashlib.sha256())
            decoded.append(hashlib.sha256())
        for number, joined in self._encodings(texts):
            ids[number].update((("," if counts[number] else "") + joined).encode())
            counts[number] += joined.count(",") + 1
            # A piece ends with a word, so no character is cut.
            raw = b"".join([self._written[i] for i in joined.split(",")])
            decoded[number].update(raw.decode("utf-8", "replace").encode())
        return [(n, i.hexdigest(), d.hexdigest()) for n, i, d in zip(counts, ids, decoded, strict=True)]

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        """For each text its ids."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for number, joined in self._encodings(texts):
            parts[number].append(np.fromstring(joined, np.int32, sep=","))
        return [np.concatenate(p) if p else np.zeros(0, np.int32) for p in parts]

    def encode(self, text: str) -> list[int]:
        return self.ids_of([text])[0].tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """Text of the ids, added tokens too; bytes that are no UTF-8 become U+FFFD."""
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")


@cache
def bpe(path: str, kept_bytes: int | None = None) -> Bpe:
    """One per worker, with what it has learnt about words."""
    return Bpe(path, kept_bytes)


def _with(frame: DataFrame, name: str, kind: DataType) -> StructType:
    return StructType([*frame.schema.fields, StructField(name, kind)])


def _slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The same rows, so many at a time that their texts take ``BATCH_BYTES``, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + BATCH_BYTES, "right")))
            yield batch.slice(first, last - first)
            first = last


def encode(documents: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``documents`` with ``token_ids``, an array of int, in place of any column of that
    name. A null text has no ids."""
    documents = documents.drop("token_ids")
    place = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, place):
            texts = batch.column(place).to_pylist()
            ids = pa.array(bpe(path).ids_of([t or "" for t in texts]), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names)

    names = [*documents.columns, "token_ids"]
    schema = _with(documents, "token_ids", ArrayType(IntegerType()))
    return documents.mapInArrow(run, schema)


def encode_and_decode(documents: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``documents`` without their text, with its ``token_ids`` and ``decoded_sha256``, the
    digest of the text that these are decoded to, in place of any columns of those names."""
    documents = documents.drop("token_ids", "decoded_sha256")
    place = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, place):
            found = bpe(path).ids_of([t or "" for t in batch.column(place).to_pylist()])
            digests = [hashlib.sha256(bpe(path).decode(ids.tolist()).encode()).hexdigest() for ids in found]
            kept = [column for i, column in enumerate(batch.columns) if i != place]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.list_(pa.int32())), pa.array(digests, pa.string())], names)
        bpe(path).forget()

    rest = documents.drop(text)
    names = [*rest.columns, "token_ids", "decoded_sha256"]
    fields = [StructField("token_ids", ArrayType(IntegerType())), StructField("decoded_sha256", StringType())]
    return documents.mapInArrow(freeing(run), StructType([*rest.schema.fields, *fields]))


def decode(encoded: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of the ids, in place of any column of that
    name; null ids give null."""
    encoded = encoded.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = [None if x is None else bpe(path).decode(x) for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    names = [*encoded.columns, "decoded"]
    return encoded.mapInArrow(run, _with(encoded, "decoded", StringType()))


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of each of the ``documents``.

    Whole texts are encoded and decoded again; the ids stay in the task. A null or empty text has no tokens. Null and repeated ``doc_id`` are rows like
    any other; columns but ``doc_id`` and ``text`` are not read.
    """
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 1):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows = bpe(path, ALONE_BYTES).encode_batch(texts)
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return round_trip(documents, tokenizer_path())
