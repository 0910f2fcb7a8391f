"""SentencePiece encoding and decoding as weighted finite-state transduction.

A model file is compiled to three machines: the normaliser (character map,
blanks to the word mark, a mark in front), the lexicon (a trie of pieces whose
arcs read characters and write piece ids) and byte fallback (arcs that read any
character no piece covers and write its UTF-8 bytes at a high cost).  A text is
normalised, composed with the lexicon to a lattice of piece arcs, and the
tropical-semiring shortest path gives its pieces.

Unigram models weight an arc by the negated piece score.  BPE models are made
of merges: a path is the model's segmentation exactly when every two neighbouring
pieces are, taken together, segmented back into those two.  That is a second
machine over pieces (weight 0 if the pair is allowed, else infinite), so the
state of the path is (position, last piece), and one path survives.

No piece continues past a word mark that follows another character, so the
lattice falls into words; words met before are kept in bounded tables.  The words
of a piece of a batch that no table holds are taken through the machines of a BPE
model together, a step of every path at a time (``Search``).

Null text gives null ids, an empty text an empty list.  Decoding joins pieces,
turns byte pieces into UTF-8 and word marks into blanks, and drops the first
blank: it returns the normalised text.  Texts of any length are encoded whole.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kensa.llm import common

MARK = "▁"
UNIGRAM, BPE = 1, 2
WORDS_KEPT = 200_000       # words in each of two tables; when the newer is full it becomes the older
PAIRS_KEPT = 250_000       # pairs of pieces; emptied when full
PAIR_BITS = 21             # of them for many paths at once: 2 ** 21 places of 8 bytes, a later pair takes an earlier one's
WORD_LONGEST = 64          # characters of a word that is kept, and whose path is followed with others'
TOGETHER = 20_000          # words whose paths are followed at once
BATCH_BYTES = 1 << 20      # of text encoded at once (or one text, if it is longer)
UNKNOWN_COST = 1000.0      # cost of an arc through byte fallback
_USER_DEFINED = (4,)
_NORMAL = (1, 4)
_BYTE = 6


def _fields(data: bytes):
    """(number, value) of a protocol buffer message's fields."""
    at = 0

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at:at + size]
            at += size


@dataclass
class Machine:
    """A compiled model."""
    kind: int
    pieces: list[str]
    scores: list[float]
    ids: dict[str, int]                # normal pieces
    bytes_: dict[int, int]             # byte value -> id
    byte_of: dict[int, int]            # id -> byte value
    unknown: int
    longest: int
    known: dict[str, bool]             # nodes of the lexicon trie: whether a piece ends there
    front: bool                        # a word mark goes before the text
    squeeze: bool                      # repeated and outer blanks are removed
    compatible: bool                   # characters are put into compatibility form
    spelt: list[bytes]                 # what each id decodes to
    words: dict[str, bytes] = field(default_factory=dict)
    older: dict[str, bytes] = field(default_factory=dict)
    allowed: dict[tuple[str, str], bool] = field(default_factory=dict)
    splits: dict[str, tuple[str, str] | None] = field(default_factory=dict)
    letters: tuple[np.ndarray, np.ndarray] | None = None
    search: Search | None = None

    def __getstate__(self):
        return self.__dict__ | {"words": {}, "older": {}, "allowed": {}, "splits": {}, "search": None}

    def normalise(self, text: str) -> str:
        """The normaliser: character map, blanks, front mark."""
        if self.compatible:
            text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f​﻿]", "", unicodedata.normalize("NFKC", re.sub(r"[\t\n\r]", " ", text)))
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (MARK if self.front else "") + text.replace(" ", MARK)

    def plain(self, text: str) -> str:
        """The normalised text as decoding gives it back."""
        text = self.normalise(text).replace(MARK, " ")
        return text[1:] if self.front and text.startswith(" ") else text

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed_ids([text])[0], np.int32).tolist()

    def packed_ids(self, texts: list[str]) -> list[bytes]:
        """The piece ids of each text as 32-bit numbers."""
        found = [self._words(self.normalise(t)) for t in texts]
        here = set().union(*found)
        if len(self.words) + len(here) > WORDS_KEPT:
            self.older, self.words = self.words, {}
        words, older = self.words, self.older
        fresh = here.difference(words)
        new = fresh.difference(older)
        words.update((w, older[w]) for w in fresh.difference(new))
        long = self._learn(new)
        out = [b"".join([words[w] for w in f]) for f in found]
        for word in long:
            del words[word]
        return out

    def _words(self, text: str) -> list[str]:
        """The words of a normalised text, without the one mark before a word; a mark more before any other stretch."""
        if text[:1] == MARK and MARK + MARK not in text:
            return text[1:].split(MARK)      # the usual text: one mark before each word
        return [w[1:] if w[0] == MARK and w[1:2] != MARK else MARK + w for w in _WORD.findall(text)]

    def _learn(self, new: set[str]) -> list[str]:
        """Put the ids of words among those kept; returns those too long to stay there."""
        together = [w for w in new if len(w) <= WORD_LONGEST] if self.kind == BPE else []
        path = self.merge_path if self.kind == BPE else self.shortest_path
        for word in new.difference(together):
            self.words[word] = array("i", path(_whole(word))).tobytes()
        if together and self.search is None:
            self.search = Search(self)
        for lo in range(0, len(together), TOGETHER):
            some = together[lo:lo + TOGETHER]
            self.words.update(zip(some, self.search.paths([_whole(w) for w in some])))
        return [w for w in new if len(w) > WORD_LONGEST]

    def arcs(self, text: str):
        """The lattice: per position, the (end, piece) arcs; the empty piece is byte fallback."""
        for at in range(len(text)):
            found = [(at + 1, text[at])] if text[at] in self.ids else [(at + 1, "")]
            for end in range(at + 2, min(len(text), at + self.longest) + 1):
                piece = text[at:end]
                whole = self.known.get(piece)
                if whole is None:
                    break
                if whole:
                    found.append((end, piece))
            yield at, found

    def shortest_path(self, text: str) -> list[int]:
        """Piece ids on the path of least cost through the lattice."""
        best: list[dict[str, tuple]] = [{} for _ in range(len(text) + 1)]   # last piece -> (cost, position, piece before)
        best[0][None] = (0.0, -1, None)
        for at, found in self.arcs(text):
            if not best[at]:
                continue
            for end, piece in found:
                key = piece or text[at]
                step = UNKNOWN_COST if not piece else 0.0 if self.kind == BPE else -self.scores[self.ids[piece]]
                for last, (cost, _, _) in best[at].items():
                    if self.kind == BPE and not (self.split(key) is not None if last is None else self.pair(last, key)):
                        continue
                    state = key if self.kind == BPE else None
                    if state not in best[end] or cost + step < best[end][state][0]:
                        best[end][state] = (cost + step, at, key if self.kind == UNIGRAM else last)
        out: list[int] = []
        end, state = len(text), next(iter(best[-1])) if best[-1] else None
        while end > 0:
            cost, at, back = best[end][state]
            piece = back if self.kind == UNIGRAM else state
            out += [self.ids[piece]] if piece in self.ids else [self.bytes_.get(b, self.unknown) for b in reversed(piece.encode())]
            end, state = at, None if self.kind == UNIGRAM else back
        return out[::-1]

    def merge_path(self, text: str) -> list[int]:
        """``shortest_path`` of a BPE model: all arcs cost 0 or nothing, so a position has one state.

        Depth first, longest piece first; a position reached before is not tried again.
        """
        n, ids, known, allowed, longest = len(text), self.ids, self.known, self.allowed, self.longest
        reached = bytearray(n + 1)
        path: list[str] = []
        waiting: list[tuple[int, str, list[str]]] = []   # position, last piece, pieces not yet tried
        at, last, found = 0, "", None
        while at < n:
            if found is None:
                found = [text[at]]
                for end in range(at + 2, min(n, at + longest) + 1):
                    piece = text[at:end]
                    whole = known.get(piece)
                    if whole is None:
                        break
                    if whole:
                        found.append(piece)
            while found:
                piece = found.pop()
                end = at + len(piece)
                if not reached[end]:
                    ok = allowed.get((last, piece)) if last else self.split(piece) is not None
                    if ok is None:
                        ok = self.pair(last, piece)
                    if ok:
                        waiting.append((at, last, found))
                        path.append(piece)
                        reached[end] = 1
                        at, last, found = end, piece, None
                        break
            else:
                at, last, found = waiting.pop()
                path.pop()
        out: list[int] = []
        for piece in path:
            out += [ids[piece]] if piece in ids else [self.bytes_.get(b, self.unknown) for b in piece.encode()]
        return out

    def pair(self, left: str, right: str) -> bool:
        """Whether merging the characters of both pieces ends in these two pieces."""
        known = self.allowed.get((left, right))
        if known is None:
            if len(self.allowed) >= PAIRS_KEPT:
                self.allowed.clear()
            known = self.allowed[left, right] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: str, right: str) -> bool:
        """No merge across the border comes before the merges that make both pieces.

        The merges are taken back, the last one first: of the pieces that meet at the border the one
        made later is replaced by its part at the border.  What could be merged across
        at that time must come later than the merge taken back (or, to the left of a merge
        on the right side, not even at the same time, as the leftmost comes first).
        """
        if self.split(left) is None or self.split(right) is None:
            return False
        ids, scores = self.ids, self.scores
        limit, also = float("inf"), False
        while True:
            across = ids.get(left + right)
            if across is not None and (-scores[across] < limit or also and -scores[across] == limit):
                return False
            l_at = -scores[ids[left]] if len(left) > 1 else None
            r_at = -scores[ids[right]] if len(right) > 1 else None
            if l_at is None and r_at is None:
                return True
            if r_at is None or l_at is not None and l_at > r_at:
                limit, also, left = l_at, False, self.split(left)[1]
            else:
                limit, also, right = r_at, True, self.split(right)[0]

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two parts whose merge makes a piece (a character: itself twice); None if merging doesn't end in it."""
        if len(piece) < 2:
            return piece, piece
        if piece not in self.splits:
            parts, last = list(piece), None
            while len(parts) > 1 and (j := self._next_merge(parts)) is not None:
                last = parts[j], parts[j + 1]
                parts[j:j + 2] = [parts[j] + parts[j + 1]]
            self.splits[piece] = last if len(parts) == 1 else None
        return self.splits[piece]

    def _next_merge(self, parts: list[str]) -> int | None:
        """The best-scored pair that makes a piece, the leftmost on ties."""
        pairs = [(-self.scores[i], j) for j in range(len(parts) - 1) if (i := self.ids.get(parts[j] + parts[j + 1])) is not None]
        return min(pairs)[1] if pairs else None

    def merge(self, text: str) -> list[str]:
        """The piece merges of a short text, carried out."""
        parts = list(text)
        while (j := self._next_merge(parts)) is not None:
            parts[j:j + 2] = [parts[j] + parts[j + 1]]
        return parts

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, np.int64), np.array([0, len(ids)]))[0]

    def decode_all(self, ids: np.ndarray, first: np.ndarray) -> list[str]:
        """Texts of piece ids laid end to end; ``first``: where each text begins, and the end."""
        if self.letters is None:
            self.letters = np.frombuffer(b"".join(self.spelt), np.uint8), np.cumsum([0, *map(len, self.spelt)])
        flat, at = self.letters
        size = at[ids + 1] - at[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        body = flat[np.arange(ends[-1]) + np.repeat(at[ids] - ends[:-1], size)].tobytes()
        cuts, out = ends[first].tolist(), []
        for a, z in zip(cuts, cuts[1:]):
            text = body[a:z].decode("utf-8", "replace").replace(MARK, " ")
            out.append(text[1:] if self.front and text.startswith(" ") else text)
        return out


class Search:
    """The lexicon and the pair machine of a BPE model as arrays, to follow the paths of many words at once.

    A symbol is a piece's id or, from the number of pieces on, a character that is no piece.  Characters have
    codes; those of no piece share code 0.  A node's arc for a code lies at its base plus the code, where it is the owner.
    """

    def __init__(self, m: Machine):
        self.m = m
        letters = sorted({c for p in m.ids for c in p})
        self.border = next(c for c in map(chr, range(len(letters) + 1)) if c not in set(letters))
        self.code = np.zeros(0x110000, np.int32)
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.names = [*m.pieces, self.border, *letters]
        self.one = np.array([m.ids.get(c, len(m.pieces) + k) for k, c in enumerate([self.border, *letters])], np.int64)
        nodes = {p: i for i, p in enumerate(m.known)}
        self.first = np.array([nodes.get(c, -1) for c in [self.border, *letters]], np.int64)
        self.best = np.zeros(len(nodes), np.int64)          # the longest piece (or character) a node's text begins with
        self.shorter = np.full(len(self.names), -1, np.int64)     # the next shorter one a piece begins with
        arcs: dict[int, list[tuple[int, int]]] = {}
        for p in sorted(nodes, key=len):
            at = nodes[p]
            if len(p) > 1:
                above = nodes[p[:-1]]
                arcs.setdefault(above, []).append((int(self.code[ord(p[-1])]), at))
                self.best[at] = self.best[above]
                if m.known[p]:
                    self.shorter[m.ids[p]] = self.best[above]
            if len(p) == 1 or m.known[p]:
                self.best[at] = m.ids[p] if p in m.ids else self.one[self.code[ord(p)]]
        self.size = np.array([len(n) for n in self.names], np.int64)
        self._place(arcs, len(nodes), len(letters) + 1)
        self.seen = np.full(1 << PAIR_BITS, -1, np.int64)      # pairs judged: the pair's number twice, plus 1 if it is allowed

    def _place(self, arcs: dict[int, list[tuple[int, int]]], n_nodes: int, n_codes: int) -> None:
        """Bases so that no two arcs lie at one place; nodes with most arcs first, those with one arc into the gaps."""
        self.base = np.zeros(n_nodes, np.int64)
        owner, target, low = [-1] * n_codes, [-1] * n_codes, n_codes
        for node in sorted(arcs, key=lambda n: -len(arcs[n])):
            codes = [c for c, _ in arcs[node]]
            least, most = min(codes), max(codes)
            while low < len(owner) and owner[low] >= 0:
                low += 1
            start = low if len(codes) == 1 else max(low, len(owner) - 64)
            for base in range(start - least, len(owner) - least + 1):
                if all(base + c >= len(owner) or owner[base + c] < 0 for c in codes):
                    break
            more = base + most + 1 - len(owner)
            if more > 0:
                owner += [-1] * more
                target += [-1] * more
            self.base[node] = base
            for c, to in arcs[node]:
                owner[base + c], target[base + c] = node, to
        self.owner, self.target = np.array([*owner, *[-1] * n_codes], np.int64), np.array(target, np.int64)

    def _longest(self, code: np.ndarray) -> np.ndarray:
        """The longest piece (or the character) that begins at each place; code 0 ends every walk."""
        best, node = self.one[code], self.first[code]
        at = np.flatnonzero(node >= 0)
        node, depth = node[at], 0
        while len(at):
            depth += 1
            arc = self.base[node] + code[at + depth]
            go = self.owner[arc] == node
            at, node = at[go], self.target[arc[go]]
            best[at] = self.best[node]
        return best

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two symbols may stand side by side (``Machine.pair``)."""
        number = left * len(self.names) + right
        place = ((number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        found = self.seen[place]
        unknown = np.flatnonzero(found >> 1 != number)
        if len(unknown):
            new, which = np.unique(number[unknown], return_inverse=True)
            judged = new * 2 + [self.m._stay_apart(self.names[k // len(self.names)], self.names[k % len(self.names)]) for k in new.tolist()]
            found[unknown] = judged[which]
            self.seen[place[unknown]] = found[unknown]
        return (found & 1).astype(bool)

    def paths(self, words: list[str]) -> list[bytes]:
        """The ids on ``merge_path`` of every word, as 32-bit numbers.

        Depth first, longest piece first, as there; in a round every word tries one piece.
        """
        text = np.frombuffer((self.border.join(words) + self.border).encode("utf-32-le"), np.uint32)
        code = self.code[text]
        longest = self._longest(code)
        size = np.fromiter(map(len, words), np.int64, len(words))
        stop = np.cumsum(size + 1) - 1
        # of a place reached: the place and the piece before it, and the piece to try there next
        before, last, rest = np.full(len(text), -1), np.full(len(text), len(self.m.pieces)), np.full(len(text), -1)
        at, end = stop - size, stop
        piece = longest[at]
        while len(at):
            to, less = at + self.size[piece], self.shorter[piece]
            ok = before[to] < 0
            ok[ok] = self.pairs(last[at[ok]], piece[ok])     # a word's first piece stands behind a border
            a, z = at[ok], to[ok]
            before[z], last[z], rest[a] = a, piece[ok], less[ok]
            at, piece = np.where(ok, to, at), np.where(ok, longest[to], less)
            back = np.flatnonzero(piece < 0)
            while len(back):
                came = before[at[back]]
                if came.min() < 0:
                    raise ValueError("a word without a path")
                at[back], piece[back] = came, rest[came]
                back = back[rest[came] < 0]
            go = at < end
            at, piece, end = at[go], piece[go], end[go]
        on, at = np.zeros(len(text), bool), stop
        while len(at):
            on[at] = True
            at = before[at]
            at = at[before[at] >= 0]
        ends = np.flatnonzero(on)
        ids, many = self._spelt(last[ends], text[ends - 1])
        cuts = (np.concatenate([[0], np.cumsum(many)])[np.cumsum(on)[stop]] * 4).tolist()
        return [ids[a:z] for a, z in zip([0, *cuts], cuts)]

    def _spelt(self, symbols: np.ndarray, final: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Ids of symbols laid end to end, and how many each has: characters that are no piece (``final``) become their bytes."""
        many, strange = np.ones(len(symbols), np.int64), symbols >= len(self.m.pieces)
        if not strange.any():
            return symbols.astype(np.int32).tobytes(), many
        chars, which = np.unique(final[strange], return_inverse=True)
        spelt = [array("i", [self.m.bytes_.get(b, self.m.unknown) for b in chr(c).encode()]).tobytes() for c in chars.tolist()]
        many[strange] = np.array([len(x) // 4 for x in spelt])[which]
        ids = np.repeat(symbols.astype(np.int32), many)
        ids[np.repeat(strange, many)] = np.frombuffer(b"".join([spelt[w] for w in which.tolist()]), np.int32)
        return ids.tobytes(), many


def _whole(word: str) -> str:
    """A word as the lattice reads it (see ``Machine._words``)."""
    return word[1:] if word[:1] == MARK else MARK + word


# a word: marks, then characters that are no mark (no piece goes on past a mark that follows another character)
_WORD = re.compile(MARK + "+[^" + MARK + "]*|[^" + MARK + "]+")


def compile_model(data: bytes) -> Machine:
    """The machines of a model file's bytes."""
    pieces, scores, kinds = [], [], []
    kind, unknown = UNIGRAM, 0
    front = squeeze = True
    name = ""
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append(piece.get(1, b"").decode())
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            kinds.append(piece.get(3, 1))
        elif number == 2:
            spec = dict(_fields(value))
            kind, unknown = spec.get(3, UNIGRAM), spec.get(40, 0)
        elif number == 3:
            spec = dict(_fields(value))
            name = spec.get(1, b"").decode()
            front, squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
    if kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are compiled")
    if name not in ("identity", "nmt_nfkc", "nfkc"):
        raise ValueError(f"normaliser {name!r} is not compiled")
    if any(k in _USER_DEFINED for k in kinds):
        raise ValueError("models with user-defined pieces are not compiled")
    ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k in _NORMAL}
    if any(MARK in p.lstrip(MARK) for p in ids):
        raise ValueError("a piece goes on past a word mark")
    byte_of = {i: int(p[3:5], 16) for i, (p, k) in enumerate(zip(pieces, kinds)) if k == _BYTE}
    return Machine(kind, pieces, scores, ids, {b: i for i, b in byte_of.items()}, byte_of, unknown, max(map(len, ids)),
                   {p[:n]: False for p in ids for n in range(1, len(p))} | {p: True for p in ids}, front, squeeze, name != "identity",
                   [bytes([byte_of[i]]) if i in byte_of else p.encode() for i, p in enumerate(pieces)])


_COMPILED: dict[bytes, Machine] = {}


def _machine(data: bytes) -> Machine:
    """One machine per worker and model."""
    if data not in _COMPILED:
        _COMPILED[data] = compile_model(data)
    return _COMPILED[data]


def encode(df: DataFrame, model: bytes, text: str = "text", ids: str = "ids", normal: str | None = None) -> DataFrame:
    """``df`` with the piece ids of its texts, and on request the normalised texts.

    Columns named as the results are replaced; other columns, repeated rows and null keys are kept
    as they are, a null text has null ids, an empty one none, an empty table gives an empty one.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c not in (ids, normal)]

    def run(batches):
        m = _machine(shared.value)
        for batch in batches:
            for rows, _, _ in common.pieces(batch, text, BATCH_BYTES):
                texts = rows.column(kept.index(text)).to_pylist()
                packed = m.packed_ids([t or "" for t in texts])
                ends = np.cumsum([0, *[len(p) // 4 for p in packed]])
                values = pa.array(np.frombuffer(b"".join(packed), np.int32))
                out = [*rows.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=pa.array([t is None for t in texts]))]
                if normal:
                    out.append(pa.array([None if t is None else m.plain(t) for t in texts], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=[*kept, ids, *([normal] if normal else [])])
        m.words, m.older = {}, {}        # a task's words; the next task's are others for the most part
        common.release()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema.fields)
    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, f"{schema}, `{ids}` array<int>" + (f", `{normal}` string" if normal else ""))


def decode(df: DataFrame, model: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the texts of its piece ids."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c != text]

    def run(batches):
        m = _machine(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256)
                values = rows.column(kept.index(ids))
                size = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                texts = m.decode_all(values.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(size)]).astype(np.int64))
                null = values.is_null().to_pylist()
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([None if n else t for n, t in zip(null, texts)], pa.string())], names=[*kept, text])
        common.release()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*[F.col(f"`{c}`") for c in kept]).schema.fields)
    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, f"{schema}, `{text}` string")
