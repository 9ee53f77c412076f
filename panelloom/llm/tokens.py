"""Token ids of whole texts from a public tokenizer file, with the ids of frequent words remembered.

A byte-pair encoder treats the words of a text independently once the text is cut at blanks, so the ids of a
text are the ids of its pieces one after another. :class:`Encoder` cuts many texts as one column and asks the
library for each new piece once; texts for which the cut would not be exact go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from panelloom.llm.workers import give_back

_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
#: A word of Latin letters, and plain punctuation after it: encoders of both kinds cut between the two.
_WORD_MARKS = rf"^(?P<word>[ \n]?{_LETTERS})(?P<marks>[!#$%&()*+,./:;<=>?@\[\]^_`{{|}}~\"-]*)$"
#: Python splits at these, the library does not.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Set where a text is to be cut; a text that has it is asked for whole.
_CUT = _SEPARATORS[0]
_WIDE_BLANKS = re.compile("[\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]").search
_LONGEST_KEPT = 64
_TOGETHER = 200

#: Characters whose distinct words are looked up together.
_GROUP_CHARS = 1 << 22
#: What a worker process holds between tasks, as others need the memory: about 25 MB.
_IDLE_PIECES = 100_000

_encoders: dict[tuple[str, int], Encoder] = {}


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes; at most ``2 * remembered`` pieces and those of one call are held.

    Of the two kinds of file, one drops blanks and marks the last token of a word, the other counts a space to
    the word after it. In the first kind pieces are words without blanks, in the second words with the space or
    line end before them. A piece is remembered, and asked for, as it stands in the text.
    """

    def __init__(self, path: str, remembered: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.remembered = remembered
        self.spaced = self.tokenizer.normalizer is None
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))).search if added else lambda text: None
        self.lower_first = self.tokenizer.normalizer is not None and "Lowercase" in str(self.tokenizer.normalizer)
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        # A space and a line end as the file spells them.
        self.edge[[i for t, i in vocabulary.items() if (t[0] in "ĠĊ" if self.spaced else t.endswith("</w>"))]] = True
        self.grouped = re.compile(("[ \n]" if self.spaced else "") + _LETTERS).fullmatch
        self.words = self.tokenizer if self.spaced else _words_only(self.tokenizer, path)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _ask(self, texts: list[str], tokenizer=None) -> list[bytes]:
        if not texts:
            return []
        found = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _ask_words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, many to a text; the tokens at a word's edge tell them apart."""
        groups = [words[i : i + _TOGETHER] for i in range(0, len(words), _TOGETHER)]
        asked = ["".join(g) if self.spaced else " ".join(g).lower() if self.lower_first else " ".join(g) for g in groups]
        out: list[bytes] = []
        for group, blob in zip(groups, self._ask(asked, self.words), strict=True):
            edges = np.flatnonzero(self.edge[np.frombuffer(blob, "<u4")])
            if len(edges) != len(group):
                out += self._ask(group)
                continue
            cuts = [*(4 * edges).tolist(), len(blob)] if self.spaced else [0, *(4 * edges + 4).tolist()]
            out += [blob[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        return out

    def _ids_of_distinct(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces; new ones are asked for together and remembered unless they are very long."""
        ids = list(map(self.known.get, pieces))
        new = [p for p, i in zip(pieces, ids, strict=True) if i is None]
        if not new:
            return ids
        found = {p: self.before[p] for p in new if p in self.before} if self.before else {}
        words, others = [], []
        for piece in new:
            if piece not in found:
                (words if self.grouped(piece) else others).append(piece)
        found.update(zip(words, self._ask_words(words), strict=True))
        found.update(zip(others, self._ask(others), strict=True))
        self.known.update(found)
        for piece in [p for p in new if len(p) > _LONGEST_KEPT]:
            del self.known[piece]
        return [found[p] if i is None else i for p, i in zip(pieces, ids, strict=True)]

    def _ids_of_pieces(self, pieces: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Ids of pieces; the marks behind a word are looked up by themselves, as many words share them."""
        halves = pc.extract_regex(pieces, _WORD_MARKS)
        cut = halves.is_valid()
        halves = [
            pc.if_else(cut, pc.struct_field(halves, "word"), pieces),
            pc.if_else(cut, pc.struct_field(halves, "marks"), pa.scalar("", pa.large_string())),
        ]
        found = []
        for half in halves:
            distinct = half.dictionary_encode()
            ids = pa.array(self._ids_of_distinct(distinct.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
            found.append(ids.take(distinct.indices))
        return pc.binary_join_element_wise(*found, pa.scalar(b"", pa.large_binary()))

    def _whole(self, text: str) -> bool:
        """Whether a text has to be asked for whole, as no cut would be exact."""
        if self.special(text) or any(c in text for c in _SEPARATORS):
            return True
        if not self.spaced:
            return False
        # Two spaces in a row, and other blanks, belong together in ways a cut at each space would lose.
        return "  " in text or any(c in text for c in "\t\r\x0b\x0c\x85\xa0") or not (text.isascii() or _plain(text))

    def _marked(self, text: str) -> str:
        """The text with what :meth:`_cut` needs to cut it."""
        if not self.spaced:
            # The file lower-cases; up to Latin-1 that is the same done here, and fewer pieces are new.
            return text.lower() if self.lower_first and _latin(text) else text
        # A line end among other blanks is not a token by itself: then it stays inside a piece.
        if "\n" in text and not ("\n\n" in text or " \n" in text or "\n " in text):
            text = text.replace("\n", _CUT + "\n")
        return text.replace(" ", _CUT + " ")

    def _cut(self, column: pa.LargeStringArray) -> pa.ListArray:
        return pc.split_pattern(column, _CUT) if self.spaced else pc.utf8_split_whitespace(column)

    def ids(self, text: str | None) -> bytes:
        """Ids of the whole text; none for a null or empty one."""
        return self.ids_of([text])[0]

    def ids_of(self, texts: list[str | None]) -> list[bytes]:
        """Ids of some texts, cut as one column: each distinct piece is looked up once, new ones are asked for together."""
        if not texts:
            return []
        if len(self.known) > self.remembered:
            self.known, self.before = {}, self.known
        whole = [bool(t) and self._whole(t) for t in texts]
        column = ["" if w or not t else self._marked(t) for t, w in zip(texts, whole, strict=True)]
        cut = self._cut(pa.array(column, pa.large_string()))
        pieces = cut.flatten().dictionary_encode()
        ids = self._ids_of_pieces(pieces.dictionary).take(pieces.indices)
        _, offsets, joined = ids.buffers()
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(cut).to_numpy())))
        ends = np.frombuffer(offsets, np.int64)[ends].tolist() if len(ids) else [0] * len(ends)
        joined = memoryview(joined or b"")
        return [
            self._ask([t])[0] if w else bytes(joined[a:b])
            for t, w, a, b in zip(texts, whole, ends, ends[1:], strict=False)
        ]

    def trim(self, most: int = _IDLE_PIECES) -> None:
        """Keep ``most`` pieces, the first learnt or used again since older ones were set aside: mostly frequent ones."""
        if len(self.known) + len(self.before) > most:
            self.known, self.before = dict(islice(self.known.items(), most)), {}


def _words_only(tokenizer, path: str):
    """``tokenizer`` for lower-case Latin-1 words alone: such words leave its normalizer unchanged and its pattern uncut.

    Only for a file whose steps are known to do so; any other is asked as it is.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    with open(path, encoding="utf-8") as f:
        steps = json.load(f)
    normal = [s["type"] for s in steps["normalizer"].get("normalizers", [steps["normalizer"]])]
    cuts = (steps["pre_tokenizer"] or {}).get("pretokenizers", [])
    if not set(normal) <= {"NFC", "Replace", "Lowercase"} or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return tokenizer
    if any(s.get("pattern") != {"Regex": r"\s+"} for s in steps["normalizer"].get("normalizers", []) if s["type"] == "Replace"):
        return tokenizer
    if r"[\p{L}]+" not in cuts[0]["pattern"].get("Regex", "").split("|") or cuts[1]["use_regex"]:
        return tokenizer
    words = Tokenizer(tokenizer.model)
    words.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return words


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _plain(text: str) -> bool:
    """No blank beyond Latin-1."""
    return not _WIDE_BLANKS(text)


@contextmanager
def encoder(path: str, idle: int = _IDLE_PIECES) -> Iterator[Encoder]:
    """The encoder of this worker process, kept between tasks with ``idle`` of its pieces."""
    key = (path, os.getpid())
    if key not in _encoders:
        _encoders[key] = Encoder(path)
    try:
        yield _encoders[key]
    finally:
        _encoders[key].trim(idle)
        give_back()


def in_groups(texts: Iterable[str | None], chars: int = _GROUP_CHARS) -> Iterator[list[str | None]]:
    """Runs of texts of about ``chars`` characters; a longer text is a run of its own."""
    held: list[str | None] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held
