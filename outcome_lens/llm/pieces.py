"""Ids of many texts under public tokenizers, each distinct piece of a batch being encoded once.

A text is cut in front of every single space that has no other white space beside it. A byte-level
pre-tokenizer starts a new word there, and so does a piece model in whose vocabulary a space is only ever in front:
what stands on both sides is encoded alike together and apart. Both are checked when a tokenizer is opened.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from outcome_lens.contract import AnalysisError

# Fixed value: white space of Unicode, and four control characters that some count to it.
SPACES = "\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
IRREGULAR = f"\\A[{SPACES}]| \\z|[{SPACES}] | [{SPACES}]|\\x00"
CUT = re.compile(f"(?<=[^{SPACES}]) (?=[^{SPACES}])")
WHITE = frozenset(chr(c) for c in range(0x3001) if re.match(f"[{SPACES}]", chr(c)))
JOINED = 500  # pieces that are encoded as one text

# Characters that every version of Unicode counts to the letters, and how a byte-level pre-tokenizer cuts texts of
# these, of ASCII digits and signs, and of line breaks.
LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u02af\u0400-\u0481\u048a-\u0523\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
SIMPLE = f"\\A[!-~{LETTERS}]([!-~{LETTERS}\n]*[!-~{LETTERS}])?\\z"
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^ \n0-9{LETTERS}]+|[ \n]+(?![^ \n])|[ \n]+")
ONE_WORD = re.compile(f"[{LETTERS}]+|[0-9]+|[!-/:-@[-`{{-~]+")


def shown_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary shows: visible Latin-1 characters show
    themselves, and the characters from 256 on the other bytes in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {chr(byte if byte in visible else next(others)): byte for byte in range(256)}


class ByteTokenizer:
    """A byte-level tokenizer file; strings of special tokens in a text are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        parts = json.loads(self.tokenizer.to_str())
        cutter = parts["pre_tokenizer"] or {}
        if parts["normalizer"] or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True):
            raise AnalysisError(f"{path} is not a plain byte-level tokenizer")
        if not all(t["special"] for t in parts["added_tokens"]):
            raise AnalysisError(f"{path} adds tokens that are not special")
        byte_of = shown_bytes()
        self.shown = np.zeros(256, "<u4")
        self.shown[list(byte_of.values())] = [ord(c) for c in byte_of]
        names = {**self.tokenizer.get_vocab(with_added_tokens=True)}
        self.bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.bytes[i] = bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode()
        self.sizes = np.array([len(b) for b in self.bytes])

    def ids(self, text: str) -> list[int]:
        # without offsets, which nobody here asks for
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def ids_of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that the pre-tokenizer would not cut, and how many each has; none may hold the character 0."""
        flat, ends = array("i"), []
        raw = np.frombuffer("\0".join(words).encode(), np.uint8)
        tokenize = self.tokenizer.model.tokenize
        for word in self.shown[raw].tobytes().decode("utf-32-le").split(chr(self.shown[0])) if words else []:
            flat.extend([t.id for t in tokenize(word)])
            ends.append(len(flat))
        return np.array(flat, np.int32), np.diff(np.array(ends, np.int64), prepend=0)


class PieceTokenizer:
    """A sentencepiece model, which puts a space in front of every text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        number = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(number)]
        if any("▁" in n.lstrip("▁") for n in names) or self.model.normalize("ａ  ﬁ") != "▁ａ▁▁ﬁ":
            raise AnalysisError(f"{path} joins words or changes characters")
        self.bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.sizes = np.array([len(b) for b in self.bytes])

    def ids(self, text: str) -> list[int]:
        """Ids of a text that starts with a space, which is the one that the model adds."""
        return self.model.encode(text[1:])


def encoded(tokenizer: ByteTokenizer | PieceTokenizer, pieces: list[str], spaced: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, each behind a space, and the number of ids of each piece.

    A byte-level tokenizer's model is asked at once for a piece that is one word.
    Other pieces without white space at an edge are encoded together, and cut apart by the bytes of their tokens. With ``spaced=False``
    pieces are encoded as they are, as a byte-level tokenizer can: joined by line breaks, each of which is one token before a word.
    """
    glue = " " if spaced else "\n"
    found, sizes, order, others = [], [], [], range(len(pieces))
    if isinstance(tokenizer, ByteTokenizer):
        one = [ONE_WORD.fullmatch(p) is not None for p in pieces]
        order, others = [i for i, w in enumerate(one) if w], [i for i, w in enumerate(one) if not w]
        ids, held = tokenizer.ids_of_words([" " + pieces[i] if spaced else pieces[i] for i in order])
        found.append(ids)
        sizes.append(held)
    plain = [i for i in others if (p := pieces[i]) and p[0] not in WHITE and p[-1] not in WHITE]
    apart = [i for i in others if not (p := pieces[i]) or p[0] in WHITE or p[-1] in WHITE]
    for at in range(0, len(plain), JOINED):
        some = plain[at : at + JOINED]
        names = [pieces[i] for i in some]
        ids = np.array(tokenizer.ids(glue + glue.join(names)), np.int32)
        ends = np.cumsum(tokenizer.sizes[ids])
        borders = np.cumsum([len(n.encode()) + 1 for n in names])
        last = np.searchsorted(ends, borders)
        if len(ends) and ends[-1] == borders[-1] and np.array_equal(ends[last], borders):
            held = np.diff(last, prepend=-1)
            if not spaced:
                ids, held = np.delete(ids, np.concatenate([[0], last[:-1] + 1])), held - 1
            found.append(ids)
            sizes.append(held)
            order += some
        else:
            apart += some
    for i in apart:
        ids = tokenizer.ids(" " + pieces[i] if spaced else pieces[i])
        found.append(np.array(ids, np.int32))
        sizes.append(np.array([len(ids)]))
    order += apart
    whose = np.array(order, np.int64)
    flat, held = np.concatenate([np.zeros(0, np.int32), *found]), np.concatenate([np.zeros(0, np.int64), *sizes])
    counts, begins = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
    counts[whose], begins[whose] = held, np.cumsum(held) - held
    return flat[ranges(begins, counts)], counts


def split(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces that texts consist of, in order, and how many each text has.

    A piece stands for a space and its own characters: the pieces of a text make up a space and the text.
    An empty text has none.
    """
    irregular = pc.match_substring_regex(column, IRREGULAR).to_numpy(zero_copy_only=False)
    empty = pc.equal(column, "").to_numpy(zero_copy_only=False)
    regular = np.flatnonzero(~irregular & ~empty)
    parts = [pc.split_pattern(column.take(pa.array(regular)), " ")]
    others = np.flatnonzero(irregular & ~empty)
    parts.append(pa.array([CUT.split(column[i].as_py()) for i in others.tolist()], pa.large_list(pa.large_string()) if pa.types.is_large_list(parts[0].type) else pa.list_(pa.large_string())))
    lists = pa.concat_arrays(parts)
    sizes = np.asarray(lists.value_lengths(), np.int64)
    flat = lists.flatten()
    # back to the order of the texts
    whose = np.concatenate([regular, others])
    counts = np.zeros(len(column), np.int64)
    counts[whose] = sizes
    if len(others):
        begins = np.zeros(len(column), np.int64)
        begins[whose] = np.cumsum(sizes) - sizes
        flat = flat.take(pa.array(ranges(begins, counts)))
    return flat, counts


def cut(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Which pieces the texts consist of, in order, how many each text has, and the distinct pieces."""
    flat, counts = split(pa.array(texts, pa.large_string()))
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(), counts, coded.dictionary.to_pylist()


def joined(strings: pa.Array, glue: str) -> str:
    return pc.binary_join(pa.LargeListArray.from_arrays([0, len(strings)], strings), pa.scalar(glue, strings.type))[0].as_py()


def unpacked(strings: pa.Array) -> list[str]:
    """``to_pylist``, in a tenth of its time."""
    out = joined(strings, "\0").split("\0")
    return out if len(out) == len(strings) else strings.to_pylist()


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``start .. start + size - 1`` of every range, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of every run of ``counts`` values, one run after the other."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return upto[ends] - upto[ends - counts]
