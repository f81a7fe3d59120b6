"""SentencePiece encoding and decoding by an Aho-Corasick automaton and one Viterbi pass.

The automaton over all pieces reports, for each end position, every piece that
ends there (its output links); the pass relaxes the best score of the prefix
ending there from the best of the prefix before the piece.

* Unigram models: a path's score is the sum of its pieces' scores.
* BPE models: sums of merge ranks aren't what the model means; its result is the
  segmentation that merging by rank gives.  A sequence of pieces is that result
  exactly if every two neighbours are what merging their joint text gives, so a
  step from piece p to piece q is admitted only if (p, q) is such a pair (decided
  once per pair and remembered).  Each prefix then has exactly one admitted last
  piece, and the same pass finds the model's own encoding in one sweep.

Both give the ids of the sentencepiece library for the same model file.
White-space pieces of equal score (ties of rank) are merged by rank directly.
Texts fall into chunks that no piece crosses; a bounded memo keeps the ids of
frequent chunks.  The model file (its path is a parameter) is read by the driver
and broadcast as bytes: its size is that of one vocabulary.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tillpoint.llm.common import text_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Piece types and model types of the file format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MEMO = 200_000


def _fields(blob: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffer message: integers, and bytes for 4-byte and sized values."""
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = blob[at]
            at += 1
            n |= (b & 127) << shift
            if b < 128:
                return n
            shift += 7

    while at < len(blob):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
            yield tag >> 3, blob[at:at + size]
            at += size


class _Memo(dict):
    """Remembered results in two generations: when the young one is full it becomes the old one, whose
    used entries move back.  At most twice ``limit`` entries stay."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class PieceModel:
    def __init__(self, blob: bytes, memo: int = MEMO):
        self.pieces, self.scores, self.types = [], [], []
        spec, norm = {}, {}
        for number, value in _fields(blob):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        piece = v.decode()
                    elif n == 2:
                        score = float(np.frombuffer(v, np.float32)[0])
                    elif n == 3:
                        kind = v
                self.pieces.append(piece)
                self.scores.append(score)
                self.types.append(kind)
            elif number == 2:
                spec = dict(_fields(value))
            elif number == 3:
                norm = dict(_fields(value))
        self.bpe = spec.get(3, UNIGRAM) == BPE
        self.byte_fallback = bool(spec.get(35, 0))
        self.dummy_prefix = bool(norm.get(3, 1))
        self.squeeze = bool(norm.get(4, 1))
        if spec.get(3, UNIGRAM) not in (UNIGRAM, BPE) or norm.get(2) or spec.get(24, 0) or not norm.get(5, 1) or USER in self.types:
            raise ValueError("only unigram and BPE models with identity normalisation, spaces as prefixes and no user symbols")
        self.unk = self.types.index(UNKNOWN)
        self.unk_surface = spec[44].decode() if 44 in spec else " ⁇ "
        self.bytes = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE}
        # inside, a plain space stands for the format's space symbol: most texts then stay one byte a character
        self.words = [p.replace(SPACE, " ") for p in self.pieces]
        self.ids = {p: i for i, (p, t) in enumerate(zip(self.words, self.types)) if t == NORMAL and p}
        self.sizes = [len(p) for p in self.pieces]
        self.unk_score = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        self._automaton(memo)
        self._decoder()

    def _automaton(self, memo: int) -> None:
        self.find = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.find.add_word(p, (i, len(p)))
        if self.ids:
            self.find.make_automaton()
        tied = {}
        for p, i in self.ids.items():
            if len(p) > 1:
                tied.setdefault(self.scores[i], []).append(p)
        ties = sorted(p for ps in tied.values() if len(ps) > 1 for p in ps)
        shortest = [p for p in ties if not any(q != p and q in p for q in ties)]
        self.tie = re.compile("|".join(map(re.escape, shortest))).search if ties else lambda text: None
        alphabet = {c for p in self.ids if len(p) > 1 for c in p} - {" "}
        crossing = any(" " in p.lstrip(" ") for p in self.ids)
        if crossing:
            self.split = re.compile(r"(?s).+")
        else:
            own = "".join(re.escape(c) for c in sorted(alphabet))
            self.split = re.compile(f"(?s) +[{own}]*|[{own}]+|." if own else "(?s).")
        self.pairs = _Memo(self._pair, 4 * memo)   # by first id * number of pieces + second id
        self.alone = _Memo(lambda i: self.merge(self.words[i]) == [i], len(self.pieces) + 1)
        self.memo = _Memo(self._chunk, memo)

    def merge(self, text: str) -> list[int | str]:
        """The model's own rule on a short text: merge the best-ranked neighbours, leftmost first, until none is a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best):
                    best, at = self.scores[i], k
            if at < 0:
                return [self.ids.get(p, p) for p in parts]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _pair(self, pair: int) -> bool:
        one, two = divmod(pair, len(self.pieces))
        return self.merge(self.words[one] + self.words[two]) == [one, two]

    def admitted(self, text: str) -> list[int] | None:
        """The BPE pass for a text whose every character is a piece: ``back[e]`` is the one admitted last
        piece of text[:e].  None if a character is no piece."""
        n = len(text)
        back = [-1] * (n + 1)
        pairs, alone, count, sizes = self.pairs, self.alone, len(self.pieces), self.sizes
        for e, (i, size) in self.find.iter(text):   # output links: all pieces that end at e, longest first
            e += 1
            if back[e] < 0:
                if e == size:
                    if alone[i]:
                        back[e] = i
                else:
                    last = back[e - size]
                    if last >= 0 and pairs[last * count + i]:
                        back[e] = i
        path = []
        while n:
            if back[n] < 0:
                return None
            path.append(back[n])
            n -= sizes[back[n]]
        return path[::-1]

    def viterbi(self, text: str) -> list[tuple[int, int]]:
        """(id, start) along the best path; a character that is no piece has id -1.

        ``best[e]`` is the score of the best path over text[:e], ``back[e]`` its last step.
        """
        n = len(text)
        best, back = [None] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        scores, pairs, alone, bpe = self.scores, self.pairs, self.alone, self.bpe
        done = 0

        def unknown(end: int) -> None:
            """Let a lone character end each prefix up to ``end`` that no piece ends, or (unigram) that costs less so."""
            nonlocal done
            while done < end:
                done += 1
                start = done - 1
                if best[start] is None:
                    continue
                if text[start] in self.ids:
                    continue
                best[done], back[done] = best[start] + self.unk_score, (-1, start)

        ending: list[tuple[int, int]] = []

        def relax(end: int) -> None:
            unknown(end)
            for i, size in ending:
                start = end - size
                if best[start] is None:
                    continue
                if bpe:
                    if best[end] is not None:
                        break
                    last = back[start]
                    if not alone[i] or last is not None and last[0] >= 0 and not pairs[last[0] * len(self.pieces) + i]:
                        continue
                score = best[start] + scores[i]
                if best[end] is None or score > best[end]:
                    best[end], back[end] = score, (i, start)

        at = -1
        for e, (i, size) in self.find.iter(text):   # output links: all pieces that end at e, longest first
            if e != at:
                if at >= 0:
                    relax(at + 1)
                ending, at = [], e
            ending.append((i, size))
        if at >= 0:
            relax(at + 1)
        unknown(n)
        path = []
        while n:
            i, start = back[n]
            path.append((i, start))
            n = start
        return path[::-1]

    def _chunk(self, text: str) -> bytes:
        if self.bpe and self.tie(text):
            merged, ids = self.merge_heap(text), []
            for p in merged:
                ids.extend([p] if isinstance(p, int) else self._lone(p))
            return np.array(ids, np.int32).tobytes()
        if self.bpe and (ids := self.admitted(text)) is not None:
            return array("i", ids).tobytes()
        ids = []
        for i, start in self.viterbi(text):
            ids.extend([i] if i >= 0 else self._lone(text[start]))
        return np.array(ids, np.int32).tobytes()

    def merge_heap(self, text: str) -> list[int | str]:
        """``merge`` for a text of any length: a heap of candidate merges over a linked list."""
        import heapq

        parts: list[str | None] = list(text)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(k: int) -> None:
            nxt = after[k]
            if k >= 0 and nxt < n and (i := self.ids.get(joint := parts[k] + parts[nxt])) is not None:
                heapq.heappush(heap, (-self.scores[i], k, joint))

        for k in range(n - 1):
            offer(k)
        while heap:
            _, k, joint = heapq.heappop(heap)
            if parts[k] is None or after[k] >= n or parts[k] + parts[after[k]] != joint:
                continue
            gone = after[k]
            parts[k], parts[gone] = joint, None
            after[k] = after[gone]
            if after[k] < n:
                before[after[k]] = k
            offer(k)
            if before[k] >= 0:
                offer(before[k])
        return [self.ids.get(p, p) for p in parts if p is not None]

    def _lone(self, char: str) -> list[int]:
        if self.byte_fallback:
            return [self.bytes[b] for b in (SPACE if char == " " else char).encode("utf-8", "surrogatepass")]
        return [self.unk]

    def encode(self, text: str) -> np.ndarray:
        text = text.replace(SPACE, " ")
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return np.zeros(0, np.int32)
        if self.dummy_prefix:
            text = " " + text
        ids = np.frombuffer(b"".join(map(self.memo.__getitem__, self.split.findall(text))), np.int32)
        if not self.byte_fallback and len(ids) > 1:   # a run of unknown characters is one unknown piece
            ids = ids[~((ids == self.unk) & np.concatenate(([False], ids[:-1] == self.unk)))]
        return ids

    def _decoder(self) -> None:
        shown = []
        for p, t in zip(self.words, self.types):
            if t == BYTE:
                shown.append(bytes([int(p[3:5], 16)]))
            elif t == CONTROL:
                shown.append(b"")
            elif t == UNKNOWN:
                shown.append(self.unk_surface.encode())
            else:
                shown.append(p.encode())
        self.shown = np.array(shown, object)

    def decode(self, ids) -> str:
        """The text of ids; the space that encoding puts first is taken off again; bytes that are no text become U+FFFD."""
        ids = np.asarray(ids, np.int64)
        raw = b"".join(self.shown[ids].tolist())
        if self.dummy_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


_MODELS: dict[int, PieceModel] = {}


def _model(shared) -> PieceModel:
    """One model per Python worker and broadcast."""
    if shared.value[0] not in _MODELS:
        _MODELS.clear()
        _MODELS[shared.value[0]] = PieceModel(shared.value[1])
    return _MODELS[shared.value[0]]


class SentencePiece:
    """Column functions for one model file.  Nulls stay null; an empty text has no ids and back."""

    def __init__(self, spark: SparkSession, path: str = MODEL):
        with open(path, "rb") as f:
            blob = f.read()
        text_batches(spark)
        PieceModel(blob, 16)   # an unsupported file fails here, not in a task
        self.shared = spark.sparkContext.broadcast((hash(blob), blob))

    def encode(self, text: Column) -> Column:
        """array<int> of piece ids."""
        shared = self.shared

        @F.pandas_udf("array<int>")
        def encode(texts: pd.Series) -> pd.Series:
            model = _model(shared)
            return pd.Series([None if t is None else model.encode(t) for t in texts], dtype=object)

        return encode(text.cast("string"))

    def encode_verified(self, text: Column) -> Column:
        """struct(token_ids array<int>, decodes boolean): the ids, and whether decoding them gives the text back
        (U+2581 is the format's own space and comes back as one)."""
        shared = self.shared

        def encode(texts: pd.Series) -> pd.DataFrame:
            model = _model(shared)
            ids = [None if t is None else model.encode(t) for t in texts]
            same = [None if t is None else model.decode(i) == t.replace(SPACE, " ") for t, i in zip(texts, ids)]
            return pd.DataFrame({"token_ids": pd.Series(ids, dtype=object), "decodes": pd.Series(same, dtype=object)})

        return F.pandas_udf(encode, "token_ids array<int>, decodes boolean")(text.cast("string"))

    def decode(self, ids: Column) -> Column:
        shared = self.shared

        @F.pandas_udf("string")
        def decode(rows: pd.Series) -> pd.Series:
            model = _model(shared)
            return pd.Series([None if r is None else model.decode(r) for r in rows], dtype=object)

        return decode(ids)
