"""BPE encoding and decoding: speculate, verify, and merge exactly only where that fails.

For each new word, greedy longest match proposes tokens.  A proposal is the true encoding
exactly if every adjacent pair of it is compatible, that is if encoding the two tokens'
joined text by itself gives the two back.  Pairs of many words are tested together: one
vectorised look-up in the sorted table of judged pairs, and the unjudged ones are judged
once.  Words with an incompatible pair are merged exactly, in order of the merges' ranks.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from talus.llm.common import batches, sliced, text_of

#: Words and spaced chunks that a Python worker remembers before it starts afresh.
REMEMBERED = 500_000
#: Characters that stand for the suffix and for no match; byte-level words hold neither.
END, NONE = "\x00", "\x01"
#: What the vocabulary's own splitting does to lower-cased printable ASCII without spaces.
PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


class Coder:
    """The encoder of a vocabulary file (byte-level BPE with an end-of-word suffix)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import WordPiece

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.merges = {(a, b): i for i, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text = {i: t for t, i in {**self.vocab, **self.special}.items()}
        self.longest = max(map(len, self.vocab))
        # the library's greedy matcher, with one character for the suffix, which no word holds
        marked = {t[: -len(self.suffix)] + END if self.suffix and t.endswith(self.suffix) else t: i for t, i in self.vocab.items()}
        self.none = len(self.vocab) + len(self.special)
        self.greedy = WordPiece({**marked, NONE: self.none}, unk_token=NONE, max_input_chars_per_word=100)
        self.greedy.continuing_subword_prefix = ""
        whole = Tokenizer.from_file(path)
        self.model = whole.model
        self.normalise, self.split = whole.normalizer.normalize_str, whole.pre_tokenizer.pre_tokenize_str
        self.judged = np.zeros(0, np.int64)  # sorted codes of judged pairs
        self.good = np.zeros(0, bool)
        #: of each word its ids and, with a space behind, its decoded text
        self.words: dict[str, tuple[bytes, bytes]] = {}
        #: the same of each chunk
        self.ids, self.said = {"": b""}, {"": b""}
        self.exact_words = 0

    def merged(self, symbols: list[str]) -> list[str]:
        """Exact merging: the lowest-ranked adjacent pair first, leftmost of equals."""
        n = len(symbols)
        parts: list[str | None] = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := self.merges.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.merges.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p in parts if p is not None]

    def symbols(self, word: str) -> list[str]:
        return [*word[:-1], word[-1] + self.suffix]

    def exact(self, word: str) -> list[int]:
        """Exact merging by the library's model, which gives what ``merged`` gives."""
        return [t.id for t in self.model.tokenize(word)]

    def propose(self, word: str) -> list[int] | None:
        """Greedy longest match over the word with its suffix."""
        out = [t.id for t in self.greedy.tokenize(word + END if self.suffix else word)]
        return self.walk(word) if not out or self.none in out else out

    def walk(self, word: str) -> list[int] | None:
        """Greedy longest match that leaves the last character to a token with the suffix; None if there is none."""
        out, at, n, vocab = [], 0, len(word), self.vocab
        while at < n:
            t = vocab.get(word[at:] + self.suffix) if n - at < self.longest else None
            if t is not None:
                out.append(t)
                return out
            for end in range(min(n - (1 if self.suffix else 0), at + self.longest), at, -1):
                t = vocab.get(word[at:end])
                if t is not None:
                    break
            if t is None:
                return None
            out.append(t)
            at = end
        return out

    def compatible(self, a: int, b: int) -> bool:
        left, right = self.text[a], self.text[b]
        end = [*right] if not (self.suffix and right.endswith(self.suffix)) else self.symbols(right[: -len(self.suffix)])
        return self.merged([*left, *end]) == [left, right]

    def learn(self, words: list[str]) -> None:
        """Encode new words together."""
        proposed = [self.propose(w) or (-1,) for w in words]
        sizes = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(sizes.sum()))
        of = np.repeat(np.arange(len(words)), sizes)
        inner = of[1:] == of[:-1]
        flat, of = (flat[:-1] << 32 | flat[1:])[inner], of[1:][inner]
        new = np.unique(flat)
        if len(self.judged):
            new = new[self.judged[np.minimum(np.searchsorted(self.judged, new), len(self.judged) - 1)] != new]
        if len(new):
            said = np.array([self.compatible(int(x) >> 32, int(x) & 0xFFFFFFFF) for x in new], bool)
            at = np.searchsorted(self.judged, new)
            self.judged, self.good = np.insert(self.judged, at, new), np.insert(self.good, at, said)
        fine = self.good[np.searchsorted(self.judged, flat)] if len(flat) else np.zeros(0, bool)
        bad = np.zeros(len(words), bool)
        bad[of[~fine]] = True
        for w, p, fails in zip(words, proposed, bad.tolist()):
            if fails or p[0] < 0:
                self.exact_words += 1
                p = self.exact(w)
            self.words[w] = self.coded(p)
        if len(self.judged) > 4 * REMEMBERED:
            self.judged, self.good = self.judged[:0], self.good[:0]

    def coded(self, ids) -> tuple[bytes, bytes]:
        return pack(f"<{len(ids)}I", *ids), (" ".join([self.text[i] for i in ids]) + " ").encode("utf-8")

    def pieces(self, chunk: str) -> list[str | int]:
        """A chunk's words, and ids of special tokens written out in it."""
        if chunk.isascii() and chunk.isprintable() and "<|" not in chunk:
            low = chunk.lower()
            return [low] if low.isalpha() else PLAIN.findall(low)
        out: list[str | int] = []
        while chunk:
            found = [(at, -len(s), s) for s in self.special if (at := chunk.find(s)) >= 0]
            at, _, s = min(found, default=(len(chunk), 0, ""))
            if at:
                out += [w for w, _ in self.split(self.normalise(chunk[:at]))]
            if s:
                out.append(self.special[s])
            chunk = chunk[at + len(s) :]
        return out

    def encode_batch(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its ids (little-endian unsigned 32-bit) and its decoded UTF-8 text."""
        if len(self.words) > REMEMBERED or len(self.ids) > REMEMBERED:
            self.words, self.ids, self.said = {}, {"": b""}, {"": b""}
        split = [t.replace("\n", " ").split(" ") for t in texts]
        fresh = {c: self.pieces(c) for c in set().union(*split).difference(self.ids)}
        self.learn(sorted({w for ws in fresh.values() for w in ws if isinstance(w, str) and w not in self.words}))
        words = self.words
        for c, ws in fresh.items():
            got = [words[w] if isinstance(w, str) else self.coded((w,)) for w in ws]
            if len(got) == 1:
                self.ids[c], self.said[c] = got[0]
            else:
                self.ids[c], self.said[c] = b"".join([x[0] for x in got]), b"".join([x[1] for x in got])
        ids_of, said_of = self.ids.__getitem__, self.said.__getitem__
        return [(b"".join(map(ids_of, parts)), b"".join(map(said_of, parts))[:-1]) for parts in split]

    def decode(self, ids: bytes) -> str:
        """The tokens' strings joined by spaces (what a file without a decoder says)."""
        return " ".join(self.text[i] for i in np.frombuffer(ids, "<u4").tolist())


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """This process's coder of a vocabulary file."""
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """A row for each document row: doc_id, n_tokens, ids (array of long), decoded string."""
    return _run(docs, path, "doc_id long, n_tokens long, ids array<long>, decoded string", lambda i, t: (len(i) // 4, np.frombuffer(i, "<u4").astype(np.int64).tolist(), t.decode("utf-8")))


def digest(docs: DataFrame, path: str) -> DataFrame:
    """A row for each document row: doc_id, n_tokens, ids_sha256, decoded_sha256 (null: empty)."""
    from hashlib import sha256

    return _run(docs, path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", lambda i, t: (len(i) // 4, sha256(i).hexdigest(), sha256(t).hexdigest()))


def _run(docs: DataFrame, path: str, schema: str, of) -> DataFrame:
    batches(docs.sparkSession)
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(parts):
            rows = [of(*x) for x in coder(path).encode_batch(b.column("text").to_pylist())]
            cols = [pa.array(c) if rows else pa.array([]) for c in zip(*rows)]
            if rows:
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], names)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)
