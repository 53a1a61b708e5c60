"""Encoding and decoding by a merge-type SentencePiece model with a table of prefixes.

In a merge model the pieces of a prefix of a text end in one certain piece,
whatever follows. The table holds that last piece for every prefix. To fill an
entry, the pieces that end there come from an Aho-Corasick automaton; a piece
is the one if it can stand behind the last piece of the prefix before it, that
is if merging the two pieces' characters gives just these two. The ids are read
backwards through the table. Work per character is bounded by the matches that
end there, also for texts without any space.

Words are parts of their own where no piece crosses a blank. Of many texts each
different word is encoded once: the tables of short ones are filled side by
side, one character of each at a step; long parts are encoded one by one.
"""

from __future__ import annotations

import codecs
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BLANK = "▁"
_BLANK_BYTES = _BLANK.encode()
_SHORT, _KNOWN_PAIRS = 40, 500_000
_SIDE_BY_SIDE, _PAIR_SLOTS, _DENSE_KINDS = 1 << 14, 1 << 20, 96


class WordTables:
    """Prefix tables of many short words at once, in arrays.

    ``pieces`` are those an encoder can reach, ``stand_together`` its test of two
    pieces. The automaton's edges are sorted keys (state, character); each state
    knows the longest piece that ends there, each piece the next shorter one.
    A character outside the vocabulary is a piece of its own, number
    ``len(pieces)``, that starts the automaton anew; ``outside`` gives its ids.
    """

    def __init__(self, pieces: list[str], ids: dict[str, int], stand_together: Callable[[str, str], bool],
                 outside: Callable[[str], list[int]]):
        self.pieces, self.stand_together, self.outside = pieces, stand_together, outside
        self.length = np.array([*map(len, pieces), 1], dtype=np.int64)
        self.ids = np.array([ids[p] for p in pieces], dtype="<i4")
        singles = [p for p in pieces if len(p) == 1]
        self.kind = np.full(0x110000, -1, dtype=np.int32)
        self.kind[[ord(c) for c in singles]] = np.arange(len(singles))
        self.kinds = len(singles)
        children: list[dict[int, int]] = [{}]
        own = [-1]  # the piece a state spells
        for number, piece in enumerate(pieces):
            state = 0
            for kind in self.kind[[ord(c) for c in piece]].tolist():
                following = children[state].get(kind)
                if following is None:
                    following = children[state][kind] = len(children)
                    children.append({})
                    own.append(-1)
                state = following
            own[state] = number
        fail, longest = [0] * len(children), own[:]
        shorter = [-1] * len(pieces)
        level, by_depth = [0], []
        while level:  # breadth first: the states a state falls back to are finished before it
            below = []
            by_depth += level
            for state in level:
                for kind, following in children[state].items():
                    back = fail[state]
                    while state and back and kind not in children[back]:
                        back = fail[back]
                    fail[following] = children[back].get(kind, 0) if state else 0
                    if own[following] >= 0:
                        shorter[own[following]] = longest[fail[following]]
                    else:
                        longest[following] = longest[fail[following]]
                    below.append(following)
            level = below
        edges = sorted((state * self.kinds + kind, following)
                       for state, known in enumerate(children) for kind, following in known.items())
        self.edge, self.target = np.array(edges, dtype=np.int64).reshape(-1, 2).T.copy()
        longest[0] = len(pieces)
        self.fail, self.longest, self.shorter = np.array(fail), np.array(longest), np.array([*shorter, -1])
        # Every transition of the kinds with the most edges, so that their steps need no search.
        at_kind = self.edge % self.kinds
        dense = np.argsort(-np.bincount(at_kind, minlength=self.kinds), kind="stable")[:_DENSE_KINDS]
        self.dense = np.full(self.kinds, -1, dtype=np.int32)
        self.dense[dense] = np.arange(len(dense))
        self.following = np.zeros((len(children), len(dense)), dtype=np.int32)
        column, begin = self.dense[at_kind], np.searchsorted(self.edge, np.arange(len(children) + 1) * self.kinds)
        for state in by_depth:  # the state to fall back to is less deep, so its row is there
            if state:
                self.following[state] = self.following[fail[state]]
            own_edges = slice(begin[state], begin[state + 1])
            self.following[state, column[own_edges][column[own_edges] >= 0]] = self.target[own_edges][column[own_edges] >= 0]
        # The last tests of pairs, by a hash of the pair; what is not found there is asked for.
        self.slot_pair = np.full(_PAIR_SLOTS, -1, dtype=np.int64)
        self.slot_good = np.zeros(_PAIR_SLOTS, dtype=bool)

    def _step(self, state: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The automaton's states after one more character of every word."""
        column = self.dense[kind]
        result = self.following[state, column].astype(np.int64)
        result[kind < 0] = 0
        todo = np.flatnonzero((kind >= 0) & (column < 0))
        state, kind = state[todo], kind[todo]
        while len(todo):
            key = state * self.kinds + kind
            at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            hit = self.edge[at] == key
            result[todo[hit]] = self.target[at[hit]]
            miss = ~hit
            todo, state, kind = todo[miss], self.fail[state[miss]], kind[miss]
        return result

    def _together(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether pieces can stand behind pieces; ``left`` is not outside the vocabulary."""
        pair = left * len(self.pieces) + right
        slot = (pair * 0x9E3779B1 >> 12) % _PAIR_SLOTS
        good = self.slot_good[slot]
        new = np.flatnonzero(self.slot_pair[slot] != pair)
        if len(new):
            asked, place = np.unique(pair[new], return_inverse=True)
            names, count = self.pieces, len(self.pieces)
            answers = np.array([self.stand_together(names[p // count], names[p % count]) for p in asked.tolist()])
            good[new] = answers[place]
            slots = (asked * 0x9E3779B1 >> 12) % _PAIR_SLOTS
            slots, first = np.unique(slots, return_index=True)
            self.slot_pair[slots], self.slot_good[slots] = asked[first], answers[first]
        return good

    def encode(self, characters: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of one character or more, one after another, and how many each word has.

        ``characters`` are those of all words, ``size`` the length of each.
        """
        first, by_size = np.cumsum(size) - size, np.argsort(-size, kind="stable")
        groups = [self._side_by_side(characters, first[g], size[g])
                  for g in (by_size[i:i + _SIDE_BY_SIDE] for i in range(0, len(size), _SIDE_BY_SIDE))]
        if not groups:
            return np.zeros(0, "<i4"), np.zeros(0, np.int64)
        tokens = np.concatenate([t for t, _ in groups])
        amount = np.empty(len(size), dtype=np.int64)
        amount[by_size] = np.concatenate([n for _, n in groups])
        behind = np.empty(len(size), dtype=np.int64)  # where a word's tokens begin among those by size
        behind[by_size] = np.cumsum(amount[by_size]) - amount[by_size]
        tokens = segments(tokens, behind, amount)
        strange = np.flatnonzero(tokens >= len(self.pieces))
        if not len(strange):
            return self.ids[tokens], amount
        # Characters outside the vocabulary have one id or several.
        known, which = np.unique(tokens[strange], return_inverse=True)
        ids = [np.array(self.outside(chr(t - len(self.pieces))), dtype="<i4") for t in known.tolist()]
        length = np.array([len(i) for i in ids], dtype=np.int64)
        begin, width = tokens.copy(), np.ones(len(tokens), dtype=np.int64)
        begin[strange] = (len(self.pieces) + np.cumsum(length) - length)[which]
        width[strange] = length[which]
        stop = np.concatenate([[0], np.cumsum(width)])
        at = np.concatenate([[0], np.cumsum(amount)])
        return segments(np.concatenate([self.ids, *ids]), begin, width), np.diff(stop[at])

    def _side_by_side(self, characters: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of words in falling order of ``size``: pieces, or their number and a character outside of them."""
        last = np.full((len(size), int(size[0]) + 1), -1, dtype=np.int32)
        state = np.zeros(len(size), dtype=np.int64)
        for end in range(1, int(size[0]) + 1):
            active = int(np.searchsorted(-size, -end, side="right"))
            state = self._step(state[:active], self.kind[characters[first[:active] + end - 1]])
            piece, word = self.longest[state], np.arange(active)
            while len(word):
                before = end - self.length[piece]
                left = last[word, before].astype(np.int64)
                good = (before == 0) | (left == len(self.pieces)) | (piece == len(self.pieces))
                later = np.flatnonzero(~good)
                good[later] = self._together(left[later], piece[later])
                last[word[good], end] = piece[good]
                word, piece = word[~good], self.shorter[piece[~good]]
                if len(piece) and piece.min() < 0:
                    raise AssertionError("a prefix without a last piece")
        # Backwards: one piece of every word at a step, the k-th from the end into column k.
        at, word, found = size.copy(), np.arange(len(size)), []
        while len(word):
            piece = last[word, at[word]].astype(np.int64)
            strange = piece == len(self.pieces)
            found.append((word, piece + np.where(strange, characters[first[word] + at[word] - 1].astype(np.int64), 0)))
            at[word] -= self.length[piece]
            word = word[at[word] > 0]
        amount = np.zeros(len(size), dtype=np.int64)
        for word, _ in found:
            amount[word] += 1
        stop = np.cumsum(amount)
        tokens = np.empty(int(stop[-1]), dtype=np.int64)
        for k, (word, token) in enumerate(found):
            tokens[stop[word] - 1 - k] = token
        return tokens, amount


def segments(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``values[begin:begin + size]`` for all, one after another."""
    stop = np.cumsum(size)
    return values[np.repeat(begin - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)]


class PieceDecoder:
    """Decoder of a merge model, given as a ``.model`` file; it needs no tables."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        self.described = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            self.described.ParseFromString(file.read())
        self.kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        trainer = self.described.trainer_spec
        if trainer.model_type != trainer.BPE or any(p.type == self.kinds.USER_DEFINED for p in self.described.pieces):
            raise ValueError("a merge model without user-defined pieces is needed")
        self.prefix_blank = self.described.normalizer_spec.add_dummy_prefix
        self.bytes = [
            b"" if p.type == self.kinds.CONTROL else bytes([int(p.piece[1:-1], 16)]) if p.type == self.kinds.BYTE
            else trainer.unk_surface.encode() if p.type == self.kinds.UNKNOWN
            else p.piece.replace(_BLANK, " ").encode() for p in self.described.pieces]
        self.normal = [p.type == self.kinds.NORMAL for p in self.described.pieces]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; control ids have none and the blank that encoding put in front goes again."""
        data = b"".join(map(self.bytes.__getitem__, ids))
        first = next((i for i in ids if self.bytes[i]), None)
        if self.prefix_blank and first is not None and self.normal[first] and data[:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "each_byte")


class PrefixEncoder(PieceDecoder):
    """Encoder and decoder of a merge model with byte fallback, given as a ``.model`` file."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        super().__init__(path)
        pieces, kinds = self.described.pieces, self.kinds
        self.normalizer = SentencePieceProcessor(model_file=path)
        self.end_id = self.normalizer.eos_id()
        self.unknown = self.normalizer.unk_id()
        self.score = {p.piece: p.score for p in pieces if p.type == kinds.NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(pieces) if p.type == kinds.NORMAL}
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(pieces) if p.type == kinds.BYTE}
        # Pieces that merging their own characters does not give never occur.
        self.halves = {p: tuple(own) for p in self.ids if len(p) > 1 and len(own := self.merged(p, 2)) == 2}
        reached = [p for p in self.ids if len(p) == 1 or p in self.halves]
        self.in_order = self._in_order()
        self.automaton = ahocorasick.Automaton()
        for piece in reached:
            self.automaton.add_word(piece, (len(piece), piece))
        self.automaton.make_automaton()
        # No piece has a blank behind another character, so no merge crosses that border.
        self.by_word = not any(_BLANK in piece.lstrip(_BLANK) for piece in self.ids)
        self.pairs: dict[tuple[str, str], bool] = {}
        # Side by side only if every character of a piece is a piece, so that each prefix ends in one.
        self.tables = (WordTables(reached, self.ids, self.stand_together, self._outside)
                       if self.by_word and {c for p in reached for c in p} <= self.ids.keys() else None)

    def _in_order(self) -> set[str]:
        """Pieces whose merges, done best first, never make a better one possible than those before."""
        found: set[str] = set()
        for piece in sorted(self.halves, key=len):
            if all(len(half) == 1 or (half in found and self.score[half] >= self.score[piece])
                   for half in self.halves[piece]):
                found.add(piece)
        return found

    def merged(self, text: str, least: int = 1) -> list[str]:
        """Pieces of a short text by merging step by step: the best pair first, of equals the leftmost.

        Merging ends early when ``least`` pieces are left.
        """
        pieces, score, none = list(text), self.score.get, float("-inf")
        scores = [score(a + b, none) for a, b in zip(pieces, pieces[1:])]
        while len(pieces) > least and scores and (best := max(scores)) > none:
            i = scores.index(best)
            pieces[i:i + 2] = [pieces[i] + pieces[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = score(pieces[i - 1] + pieces[i], none)
            if i < len(scores):
                scores[i] = score(pieces[i] + pieces[i + 1], none)
        return pieces

    def stand_together(self, left: str, right: str) -> bool:
        """Whether merging the characters of both pieces gives just these two."""
        pair = left, right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= _KNOWN_PAIRS:
                self.pairs.clear()
            if all(len(piece) == 1 or piece in self.in_order for piece in pair):
                known = not self._merge_across(left, right)
            else:
                known = self.merged(left + right) == [left, right]
            self.pairs[pair] = known
        return known

    def _merge_across(self, left: str, right: str) -> bool:
        """Whether some merge joins the two pieces (both in order), going back through their own merges.

        The merge done last is undone first. Its place is taken by one across the
        border if that is better, or as good and further left.
        """
        score, halves, none = self.score, self.halves, float("-inf")
        limit, ties = none, False
        while True:
            across = score.get(left + right, none)
            if across > limit or (ties and across == limit):
                return True
            last_left = score[left] if len(left) > 1 else float("inf")
            last_right = score[right] if len(right) > 1 else float("inf")
            if len(right) > 1 and last_right <= last_left:
                limit, ties, right = last_right, True, halves[right][0]
            elif len(left) > 1:
                limit, ties, left = last_left, False, halves[left][1]
            else:
                return False

    def pieces(self, text: str) -> list[str]:
        """Pieces of a normalised text; characters outside the vocabulary are pieces of their own."""
        last: list[str] = [""] * (len(text) + 1)
        together, done = self.pairs.get, 0
        for end, (length, piece) in self.automaton.iter(text):
            end += 1
            if last[end]:
                continue
            for missed in range(done + 1, end):  # no piece ended there: a character outside the vocabulary
                last[missed] = last[missed] or text[missed - 1]
            done = max(done, end - 1)
            before = last[end - length]
            if end == length or (together((before, piece)) if (before, piece) in self.pairs
                                 else self.stand_together(before, piece)):
                last[end] = piece
        found, at = [], len(text)
        while at:
            piece = last[at] or text[at - 1]
            found.append(piece)
            at -= len(piece)
        found.reverse()
        return found

    def _outside(self, character: str) -> list[int]:
        return [self.byte_id[b] for b in character.encode()] if self.byte_id else [self.unknown]

    def _encoded(self, part: str) -> np.ndarray:
        ids: list[int] = []
        for piece in self.pieces(part):
            known = self.ids.get(piece)
            ids += [known] if known is not None else self._outside(piece)
        return np.array(ids, dtype="<i4")

    def _cut(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """All parts of the normalised texts, and how many each text has.

        "a__b" is cut to "a" and "__b": blanks belong to what follows them. So a
        part begins with a text and at every blank that is not behind another.
        """
        normal = [self.normalizer.normalize(t).encode() if t else b"" for t in texts]
        data = b"".join(normal)
        size = np.array([len(n) for n in normal], dtype=np.int64)
        first = np.cumsum(size) - size
        begins = np.zeros(len(data) + 1, dtype=bool)
        if self.by_word:
            flat = np.frombuffer(data, dtype=np.uint8)
            blank = np.zeros(len(data) + 3, dtype=bool)  # blank[i + 3]: a blank of three bytes begins at i
            if len(data) >= 3:
                blank[3:-2] = (flat[:-2] == _BLANK_BYTES[0]) & (flat[1:-1] == _BLANK_BYTES[1]) & (flat[2:] == _BLANK_BYTES[2])
            begins[:-1] = blank[3:] & ~blank[:-3]
        begins[first[size > 0]] = True
        begins[-1] = True
        at = np.flatnonzero(begins)
        offsets = pa.py_buffer(at.astype(np.int32) if len(data) else np.zeros(1, np.int32))
        parts = pa.StringArray.from_buffers(len(at) - 1 if len(data) else 0, offsets, pa.py_buffer(data))
        until = np.searchsorted(at, [*first, len(data)])
        return parts.dictionary_encode(), np.diff(until)

    def _words(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each has: short ones side by side, others one by one."""
        size = pc.utf8_length(words).to_numpy().astype(np.int64)
        short = size <= _SHORT if self.tables is not None else np.zeros(len(size), dtype=bool)
        some = words.filter(pa.array(short))
        characters = np.frombuffer("".join(some.to_pylist()).encode("utf-32-le"), "<u4")
        ids, own = self.tables.encode(characters, size[short]) if len(some) else (np.zeros(0, "<i4"), np.zeros(0, np.int64))
        if len(some) == len(words):
            return ids, own
        others = [self._encoded(word) for word in words.filter(pa.array(~short)).to_pylist()]
        amount, begin = np.empty(len(size), dtype=np.int64), np.empty(len(size), dtype=np.int64)
        amount[short], amount[~short] = own, [len(i) for i in others]
        begin[short], begin[~short] = np.cumsum(own) - own, len(ids) + np.cumsum(amount[~short]) - amount[~short]
        return segments(np.concatenate([ids, *others]), begin, amount), amount

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, without end ids; each different word is encoded once."""
        cut, parts = self._cut(texts)
        if not len(cut):
            return [np.zeros(0, dtype="<i4")] * len(texts)
        ids, amount = self._words(cut.dictionary)
        which = cut.indices.to_numpy()
        found = segments(ids, (np.cumsum(amount) - amount)[which], amount[which])
        stop = np.concatenate([[0], np.cumsum(amount[which])])
        return np.split(found, stop[np.cumsum(parts)[:-1]])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, without an end id."""
        return self.encode_all([text])[0]


# Every byte that is no part of a character is one replacement character.
codecs.register_error("each_byte", lambda error: ("\ufffd" * (error.end - error.start), error.end))

_encoders: dict[str, PrefixEncoder] = {}


def encoder(path: str) -> PrefixEncoder:
    """One encoder for each file and worker process."""
    if path not in _encoders:
        _encoders[path] = PrefixEncoder(path)
    return _encoders[path]


_decoders: dict[str, PieceDecoder] = {}


def decoder(path: str) -> PieceDecoder:
    """One decoder for each file and worker process."""
    if path not in _decoders:
        _decoders[path] = PieceDecoder(path)
    return _decoders[path]


def encode_documents(docs: DataFrame, path: str, at_once: int = 1 << 22) -> DataFrame:
    """doc_id and ids (with the end id) of every row; texts are encoded some ``at_once`` characters at a time.

    Null and empty texts have only the end id. Repeated rows are each encoded,
    extra columns ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        end = np.array([own.end_id], dtype=np.int32)
        for batch in batches:
            first, texts, total = 0, [], 0
            for i, text in enumerate(batch.column(1)):
                texts.append(text.as_py() or "")
                total += len(texts[-1])
                if total >= at_once or i == batch.num_rows - 1:
                    rows = [np.concatenate([ids, end]) for ids in own.encode_all(texts)]
                    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(rows)), ids],
                                                     names=["doc_id", "ids"])
                    first, texts, total = i + 1, [], 0

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded(doc_id, ids)`` with their decoded text; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(path)
        for batch in batches:
            texts = [None if ids.as_py() is None else own.decode(ids.values.to_numpy().tolist()) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, text string")


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of ``coded(doc_id, ids, text)``."""
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
