"""BPE as a streaming transducer, and its inverse.

Encoding. A token sequence is the encoding of its text exactly if every two neighbours
encode to themselves, so each prefix of a word has one last token: the token that
ends there and agrees with the last token of what precedes it. Reading a word from the
left thus needs one back pointer per position. A token that ends beyond the current
position starts at most ``lookahead`` symbols before it (one less than the longest
token of the merge list); once the back pointers of those positions have met, everything before
the meeting point is stable and is emitted. The window between that point and the
current position is all that is kept. What the transducer does with a symbol depends only on its state: the tokens that may still
be under way, each with the token before it. States and their moves are made when first needed and kept up to a bound, so known
moves cost one look-up. The ids of frequent words are remembered in a small table; every word that is not in it
goes through the transducer, and a long one's ids leave it piece by piece.

Decoding. Ids go through a state machine that holds at most the bytes of one unfinished character.

Text is read in slices that end at white space. Null text counts as empty: no tokens.
Repeated rows give repeated results. Letters, digits and lower case are the library's, whichever
version of Unicode Python and the pattern engine have.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kerbstat.llm.common import beside_ids, in_parts, texts

SLICE = 1 << 16  # characters
REMEMBERED = 200_000  # words, and pairs of tokens, per task
MOVES = 150_000  # of the transducer that a task remembers
INNER, FINAL = 0, 1
KEPT_IDS = 16  # of a word that is remembered
OUT_IDS = 4_096  # of a long word that are passed on together
OUT_BYTES = 4_000_000  # of ids in a batch of results
WHITE = "\t-\r \x85\xa0  -     　"
# The word pattern that the tokenizer file declares, with its letters and digits left open.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[LETTERS]+|[DIGITS]|[^" + WHITE + "LETTERSDIGITS]+"
ASCII_WORDS = re.compile(WORDS.replace("LETTERS", "a-z").replace("DIGITS", "0-9"))
# First and last of the runs of letters and digits that Unicode 16 added, and the small forms of capitals that 16 and 17 added.
ADDED = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C),
    (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA),
]
ADDED_CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
ADDED_CAPITALS |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
HAS_ADDED_CAPITAL = re.compile(f"[{''.join(chr(c) for c in ADDED_CAPITALS if c < 0x10000)}]")
BEYOND = re.compile("[\U00010000-\U0010ffff]")  # classes without such code points are looked up faster


@functools.lru_cache(2)
def word_pattern(last: int = 0x10FFFF) -> re.Pattern:
    """The word pattern for text of code points up to ``last``, made once per Python process. Code points that Python's tables, which are no newer, leave unassigned
    and Unicode 16 did not add are neither letters nor digits, whatever the engine that has the classes says.
    """
    points = "".join(chr(c) for c in range(last + 1) if not 0xD800 <= c < 0xE000)
    added = {c for a, b in ADDED for c in range(a, b + 1)}

    def runs(kind: str) -> str:
        held = {c for c in map(ord, regex.findall(kind, points)) if c in added or unicodedata.category(chr(c)) != "Cn"}
        starts, ends = sorted(c for c in held if c - 1 not in held), sorted(c for c in held if c + 1 not in held)
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))

    return re.compile(WORDS.replace("LETTERS", runs(r"\p{L}")).replace("DIGITS", runs(r"\p{N}")))


def byte_alphabet() -> list[str]:
    """A printable character per byte: itself where it prints, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def read_spec(path: str) -> dict:
    """The parts of a tokenizer file that encoding and decoding need."""
    with open(path, encoding="utf-8") as file:
        raw = json.load(file)
    return {
        "vocab": raw["model"]["vocab"],
        "merges": [tuple(m.split(" ") if isinstance(m, str) else m) for m in raw["model"]["merges"]],
        "end": raw["model"]["end_of_word_suffix"] or "",
        "special": {t["content"]: t["id"] for t in raw["added_tokens"]},
    }


class Node(dict):
    """A place in the tree of tokens; equal only to itself."""

    __slots__ = ()
    __hash__ = object.__hash__
    __eq__ = object.__eq__


class Encoder:
    def __init__(self, spec: dict, remembered: int = REMEMBERED, moves: int = MOVES):
        self.most_moves, self.half = moves, max(1, remembered // 2)
        self.vocab, self.end, self.special = spec["vocab"], spec["end"], spec["special"]
        self.rank = {pair: i for i, pair in reversed(list(enumerate(spec["merges"])))}
        self.symbol = byte_alphabet()
        longest = max((len((a + b).removesuffix(self.end)) for a, b in self.rank), default=1)
        self.lookahead = max(1, longest) - 1
        makes = {a + b: i for i, (a, b) in reversed(list(enumerate(spec["merges"])))}
        # True if every merge comes after those that make its parts.
        self.ordered = all(max(makes.get(a, -1), makes.get(b, -1)) < i for (a, b), i in self.rank.items())
        # What was needed of late; when a table is half of what may be remembered, it becomes the older one and the older one goes.
        self.agree: dict[tuple[str, str], bool] = {}
        self.older_agree: dict[tuple[str, str], bool] = {}
        self.made: dict[str, tuple[str, str]] = {}
        self.edges: dict[tuple[str, int], list[tuple[str, int, int]]] = {}
        self.alone: dict[str, bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}
        self.older_words: dict[str, tuple[int, ...]] = {}
        # Tokens by their symbols; INNER and FINAL lead to the token that ends there, within a word and at its end.
        self.root = Node()
        for token in self.vocab:
            node, final = self.root, bool(self.end) and token.endswith(self.end)
            for symbol in token.removesuffix(self.end):
                node = node.get(symbol) or node.setdefault(symbol, Node())
            for kind in (FINAL,) if final else (INNER,) if self.end else (INNER, FINAL):
                node[kind] = token
        # A state holds, under None, the token before and the place in the tree of each token under way, the longest first; under a symbol
        # its move: the next state and the token that ends there. Under a word's last symbol, with a mark, is the word's last token.
        self.first: dict = {None: (("", self.root),)}
        self.states: dict[tuple, dict] = {}
        self.moves = 0
        marks = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(marks) + ")") if marks else None

    # --- the merge list, applied to one token ------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """The text's tokens, by the merge list itself; notes the last merge of each token that it makes."""
        parts = list(text.removesuffix(self.end)) if self.end else list(text)
        if self.end and text.endswith(self.end) and parts:
            parts[-1] += self.end
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (self.rank.get((parts[i], parts[i + 1]), 1 << 60), i))
            pair = (parts[best], parts[best + 1])
            if pair not in self.rank:
                break
            parts[best : best + 2] = [pair[0] + pair[1]]
            self.made.setdefault(pair[0] + pair[1], pair)
        return parts

    def is_token(self, piece: str) -> bool:
        known = self.alone.get(piece)
        if known is None:
            known = self.alone[piece] = self.merged(piece) == [piece]
        return known

    def edge(self, token: str, side: int) -> list[tuple[str, int, int]]:
        """The parts that stand at one edge of a token while it is made: text, rank that makes it, rank that uses it."""
        known = self.edges.get((token, side))
        if known is None:
            known, part, used = [], token, 1 << 60
            while True:
                pair = self.made.get(part)
                made = self.rank[pair] if pair else -1
                known.append((part, made, used))
                if not pair:
                    break
                part, used = pair[side], made
            self.edges[(token, side)] = known
        return known

    def follows(self, left: str, right: str) -> bool:
        """True if no merge joins an edge part of ``left`` to one of ``right`` while both stand; of equal ranks the left goes first."""
        key = (left, right)
        known = self.agree.get(key)
        if known is not None:
            return known
        known = self.older_agree.get(key)
        if known is None and self.ordered:
            rank, facing, known = self.rank, self.edge(right, 0), True
            for a, a_made, a_used in self.edge(left, 1):
                for b, b_made, b_used in facing:
                    r = rank.get((a, b))
                    if r is not None and r < a_used and r <= b_used and a_made <= b_used and b_made < a_used:
                        known = False
        elif known is None:
            known = self.merged(left + right) == [left, right]
        if len(self.agree) >= self.half:
            self.older_agree, self.agree = self.agree, {}
        self.agree[key] = known
        return known

    # --- one word ------------------------------------------------------------------------------

    def forget(self) -> None:
        """Drop all moves; a state that is in use keeps what it holds under None."""
        for state in (self.first, *self.states.values()):
            under_way = state[None]
            state.clear()
            state[None] = under_way
        self.states, self.moves = {}, 0

    def move(self, state: dict, symbol: str, kind: int) -> tuple[dict | None, str | None]:
        """What ``symbol`` does: the state after it (none after a word's last symbol) and the token that ends with it."""
        if self.moves >= self.most_moves:
            self.forget()
        self.moves += 1
        still, found, alone = [], None, self.alone
        for before, node in state[None]:
            node = node.get(symbol)
            if node is None:
                continue
            still.append((before, node))
            if found is None and (piece := node.get(kind)) is not None:
                if (alone.get(piece) or self.is_token(piece)) and (not before or self.follows(before, piece)):
                    found = piece
        if kind == FINAL:
            state[symbol + "$"] = made = (None, found)
            return made
        if found is not None:
            still.append((found, self.root))
        under_way = tuple(still)
        after = self.states.get(under_way)
        if after is None:
            after = self.states[under_way] = {None: under_way}
        state[symbol] = made = (after, found)
        return made

    def stable(self, symbols: str) -> Iterator[list[int]]:
        """Ids of a word given by its symbols, in pieces, each as soon as no further symbol can change it."""
        limit, size = 4 * (self.lookahead + 1), len(symbols)
        last: list[str | None] = [""]  # by end position from ``done`` on, inside the window only
        done, i, state = 0, 0, self.first
        for symbol in symbols[:-1]:
            i += 1
            state, found = state.get(symbol) or self.move(state, symbol, INNER)
            last.append(found)
            if i - done >= limit:
                at = self.meeting(last, done)
                yield self.between(last, done, at)
                del last[: at - done]
                done = at
        last.append((state.get(symbols[-1] + "$") or self.move(state, symbols[-1], FINAL))[1])
        yield self.between(last, done, size)

    def width(self, token: str) -> int:
        return len(token.removesuffix(self.end))

    def meeting(self, last: list[str | None], done: int) -> int:
        """Where the back pointers of all positions from which a later token may start meet."""
        i = done + len(last) - 1
        front = {p for p in range(i - self.lookahead, i + 1) if last[p - done] is not None}
        while len(front) > 1:
            p = max(front)
            front.remove(p)
            front.add(p - self.width(last[p - done]))
        return front.pop()

    def between(self, last: list[str | None], done: int, at: int) -> list[int]:
        back, start = [], done
        while at > start:
            token = last[at - start]
            back.append(self.vocab[token])
            at -= self.width(token)
        return back[::-1]

    def word(self, word: str) -> Iterator[list[int]]:
        """Ids of a word, in pieces, through the transducer."""
        plain = word.isascii() and word.isalnum()  # such bytes are their own symbols
        return self.stable(word if plain else "".join(map(self.symbol.__getitem__, word.encode("utf-8"))))

    # --- whole texts ---------------------------------------------------------------------------

    def slices(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > SLICE:
            cut = max(text.rfind(" ", start + 1, start + SLICE), text.rfind("\n", start + 1, start + SLICE))
            if cut < 0:
                found = re.compile(f"[{WHITE}]").search(text, start + SLICE)
                cut = found.start() if found else len(text)
            yield text[start:cut]
            start = cut
        yield text[start:]

    def stream(self, text: str | None) -> Iterator[list[int]]:
        """Ids of a text, in order, a slice's or some thousand at a time."""
        parts = self.marks.split(text or "") if self.marks and "<" in (text or "") else [text or ""]
        for part in parts:
            if part in self.special:
                yield [self.special[part]]
                continue
            for piece in self.slices(part):
                yield from self._ids(piece)

    def _ids(self, piece: str) -> Iterator[list[int]]:
        if piece.isascii():
            pattern, piece = ASCII_WORDS, piece.lower()
        else:
            piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
            beyond = BEYOND.search(piece)
            pattern = word_pattern() if beyond else word_pattern(0xFFFF)
            if beyond or HAS_ADDED_CAPITAL.search(piece):
                piece = piece.translate(ADDED_CAPITALS)
        ids: list[int] = []
        known = self.words
        for w in pattern.findall(piece):
            got = known.get(w)
            if got is None:
                got, whole = self.older_words.get(w), True
                if got is None:
                    fresh = self.word(w)
                    got = next(fresh)
                    for more in fresh:
                        ids.extend(got)
                        got, whole = more, False
                        if len(ids) >= OUT_IDS:
                            yield ids
                            ids = []
                if whole and len(got) < KEPT_IDS:
                    if len(known) >= self.half:
                        self.older_words, self.words = known, {}
                        known = self.words
                    known[w] = got = tuple(got)
            ids.extend(got)
        yield ids


class Decoder:
    """Ids to text. ``spaced`` joins the tokens' own texts by a space, as the library does for files
    without a decoder; otherwise byte symbols become bytes, word ends become spaces, and bytes become text.
    """

    def __init__(self, spec: dict, spaced: bool = True):
        self.spaced, end = spaced, spec["end"]
        byte = {c: b for b, c in enumerate(byte_alphabet())}
        names = {i: t for t, i in spec["vocab"].items()} | {i: t for t, i in spec["special"].items()}
        special = set(spec["special"].values())
        self.piece: dict[int, bytes] = {}
        for i, name in names.items():
            if spaced or i in special:
                self.piece[i] = name.encode("utf-8")
            else:
                body = bytes(byte[c] for c in name.removesuffix(end))
                self.piece[i] = body + (b" " if end and name.endswith(end) else b"")
        self.start()

    def start(self) -> None:
        self.begun, self.state = False, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        """The text that these ids complete; an unfinished character stays in the state."""
        if not len(ids):
            return ""
        between = b" " if self.spaced else b""
        raw = between.join(map(self.piece.__getitem__, ids))
        raw, self.begun = (between if self.begun else b"") + raw, True
        return self.state.decode(raw)

    def finish(self) -> str:
        return self.state.decode(b"", True)


def encode_documents(
    docs: DataFrame, spec: dict, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, remembered: int = REMEMBERED
) -> DataFrame:
    """A row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids``
    (little-endian 32-bit integers). Nothing is shuffled; the vocabulary, of fixed size, is broadcast. A task remembers
    the ids of ``remembered`` words, some 25 MB for 100,000, and ``MOVES`` moves of the transducer, some 40 MB; fewer cost time only.
    """
    source = texts(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    key = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(shared.value, remembered), Decoder(shared.value)
        decimal = [b"%d" % i for i in range(max(decoder.piece, default=-1) + 1)]
        types = [pa.int64(), pa.string(), pa.string(), pa.binary()]

        def result(part: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(("n_tokens", "ids_sha256", "decoded_sha256", "ids"), (pa.array(list(x), t) for x, t in zip(zip(*rows), types)))
            return beside_ids(part, **{n: x for n, x in columns if with_ids or n != "ids"})

        for part, lines in (p for batch in batches for p in in_parts(batch)):
            rows, first, held = [], 0, 0
            for i, text in enumerate(lines):
                ids_hash, text_hash, n, kept = hashlib.sha256(), hashlib.sha256(), 0, []
                decoder.start()
                for ids in encoder.stream(text):
                    if not ids:
                        continue
                    ids_hash.update((b" " if n else b"") + b" ".join(map(decimal.__getitem__, ids)))
                    text_hash.update(decoder.feed(ids).encode("utf-8"))
                    n += len(ids)
                    if with_ids:
                        kept.append(np.asarray(ids, "<u4").tobytes())
                text_hash.update(decoder.finish().encode("utf-8"))
                rows.append((n, ids_hash.hexdigest(), text_hash.hexdigest(), b"".join(kept)))
                held += 4 * n
                if held >= OUT_BYTES or i == len(lines) - 1:
                    yield result(part.slice(first, len(rows)), rows)
                    rows, first, held = [], i + 1, 0

    schema = f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return source.mapInArrow(run, schema + (", ids binary" if with_ids else ""))
