"""Texts as stretches between blanks, each distinct one of a batch handled once."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are cut together; a longer text is cut alone.
SLICE = 4 << 20

#: A blank after anything but white space starts a new stretch.
_BLANK = re.compile(r"(?<=\S) ")
#: Without these all blanks do: white space before a blank, or one at the start.
_UNUSUAL = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] |^ "


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """(from, to) of neighbouring texts of at most ``most`` bytes together, or of one that is longer."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield start, stop
        start = stop


def cut(texts: pa.Array, lead: bool = False) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct stretches, the number of the stretch at each place, and where each text's places end.

    A stretch holds the blank that starts it. The first of a text has none, unless ``lead``
    puts one before every text. Null is empty: one empty stretch.
    """
    texts = pc.fill_null(texts, "")
    unusual = pc.match_substring_regex(texts, _UNUSUAL).to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(texts, " ")
    if unusual.any():
        by_rule = pa.array([_BLANK.split(t) for t in texts.filter(pa.array(unusual)).to_pylist()], lists.type)
        places = np.where(unusual, len(texts) - unusual.sum() + np.cumsum(unusual) - 1, np.cumsum(~unusual) - 1)
        lists = pa.concat_arrays([lists.filter(pa.array(~unusual)), by_rule]).take(pa.array(places))
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
    coded = lists.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    distinct = [" " + word for word in words]
    if not lead and len(ends):
        firsts = np.concatenate([[0], ends[:-1]])
        used, at = np.unique(codes[firsts], return_inverse=True)
        codes[firsts] = len(words) + at
        distinct += [words[i] for i in used]
    return distinct, codes, ends


class Lists:
    """Lists of numbers, one after another: ``values`` and each list's ``lengths``."""

    def __init__(self, values: np.ndarray, lengths: np.ndarray):
        self.values, self.lengths = values, lengths
        self.starts = np.cumsum(lengths) - lengths

    def take(self, which: np.ndarray) -> Lists:
        """The lists of these numbers, in this order, repeats included."""
        lengths = self.lengths[which]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[which] - (ends - lengths), lengths) + np.arange(total)
        return Lists(self.values[at], lengths)


def byte_alphabet() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies.

    Bytes that print in Latin-1 stand for themselves; the others follow from U+0100 on.
    """
    printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printing]
    return {chr(b): b for b in printing} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids by a byte-level tokenizer of the ``tokenizers`` library, without special tokens.

    Such tokenizers, with the usual pattern, never let a token reach over a blank that
    follows something other than white space, so stretches can be encoded one by one. Where
    ids rank the merges, ``tiktoken`` finds the same ids: stretches that no one could read
    differently are then joined and encoded in one call, all others by the tokenizer itself.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        declared = json.loads(vocabulary)
        self.special = [token["content"] for token in declared.get("added_tokens", [])]
        self.ranked, self.sizes = self._ranked(declared)

    @staticmethod
    def _ranked(declared: dict):
        """The vocabulary as ranks, if merging by rank is all that the tokenizer does."""
        model, cutter = declared["model"], declared.get("pre_tokenizer") or {}
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if declared.get("normalizer") or model.get("dropout") or model.get("ignore_merges") or plain.items() - cutter.items():
            return None, None
        entries, letters = model["vocab"], byte_alphabet()
        merges = [entries["".join(pair) if isinstance(pair, list) else pair.replace(" ", "", 1)] for pair in model["merges"]]
        added = {token["content"] for token in declared.get("added_tokens", [])}
        ranks = {bytes(letters[c] for c in entry): i for entry, i in entries.items() if entry not in added}
        if len(ranks) != 256 + len(merges) or merges != sorted(merges) or merges[0] < 256:
            return None, None
        import tiktoken
        from public_tokenizers import PATTERN

        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        sizes[list(ranks.values())] = [len(entry) for entry in ranks]
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes

    def plain(self) -> Encoder:
        """The strings of special tokens are plain text from now on."""
        self.tokenizer.encode_special_tokens = True
        self.special = []
        return self

    def encode(self, texts: list[str]) -> Lists:
        if self.ranked is None:
            return self._by_tokenizer(texts)
        joins = np.fromiter((t[:1] == " " and not t[-1].isspace() for t in texts), bool, len(texts))
        for special in self.special:
            if special in "".join(texts):
                joins &= [special not in t for t in texts]
        apart = np.flatnonzero(~joins)
        joined = texts if not len(apart) else [t for t, joined in zip(texts, joins.tolist(), strict=True) if joined]
        ids = self.ranked.encode_to_numpy("".join(joined), disallowed_special=())
        stops = np.cumsum(np.fromiter((len(t.encode()) for t in joined), np.int64, len(joined)))
        spelled = np.cumsum(self.sizes[ids])
        at = np.searchsorted(spelled, stops)
        if not np.array_equal(spelled[at] if len(ids) else stops, stops):
            raise ValueError("a token reaches from one stretch into the next")
        found = Lists(ids, np.diff(np.concatenate([[0], at + 1]))) if len(joined) else Lists(np.zeros(0, np.uint32), np.zeros(0, np.int64))
        if not len(apart):
            return found
        rest = self._by_tokenizer([texts[i] for i in apart.tolist()])
        place = np.zeros(len(texts), np.int64)
        place[joins], place[apart] = np.arange(len(joined)), len(joined) + np.arange(len(apart))
        both = Lists(np.concatenate([found.values, rest.values]), np.concatenate([found.lengths, rest.lengths]))
        return both.take(place)

    def _by_tokenizer(self, texts: list[str]) -> Lists:
        values, lengths = array("I"), np.zeros(len(texts), np.int64)
        for at in range(0, len(texts), 1 << 14):
            for i, encoding in enumerate(self.tokenizer.encode_batch_fast(texts[at : at + (1 << 14)], add_special_tokens=False), at):
                ids = encoding.ids
                lengths[i] = len(ids)
                values.extend(ids)
        return Lists(np.array(values, np.uint32), lengths)
