"""Pre-token cache in front of a tokenizers-library model whose pre-tokens encode independently.

For a normaliser that maps characters one by one and a pre-tokenizer that splits at white space, the ids of a
text are the ids of its pre-tokens one after the other. Which characters that holds for is asked of the library,
character by character, when the encoder is built; a text with any other character, or with a special token's
opening, goes through the library whole. So results equal the library's on every text.

Many texts at once are cut into words by Arrow; only the distinct words of a group meet the table of words, and the
ids of the texts are gathered from theirs by number.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain, repeat
from string import ascii_letters

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from retentia.llm.common import Generations, Made, held

# Characters asked about: Latin blocks and general punctuation.
CANDIDATES = [*range(0x00, 0x180), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC, 0x2122]
# Bytes of the tables of white-space words and of pre-tokens.
WORD_BYTES, PRETOKEN_BYTES = 256_000_000, 160_000_000
# Texts are worked on in groups of about so many characters, whatever the Arrow batch holds.
GROUP_CHARS = 500_000
# Groups whose words are numbered are larger, so that most words are not the first of their kind.
GROUP_BYTES = 24_000_000
# So many pre-tokens go through the model in one call.
JOINED = 2000
# In place of a word's ids: its texts go through the library whole. No ids have one byte.
ODD = b"?"
# Where Arrow cuts words: white space of one byte.
CUTS = " \t\n\x0b\x0c\r"


def as_bytes(coded: list[list[int]]) -> list[bytes]:
    """Each list as little-endian uint32s."""
    ends = list(accumulate(map(len, coded), initial=0))
    data = np.fromiter(chain.from_iterable(coded), "<u4", ends[-1]).tobytes()
    return [data[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]


def gathered(values: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(uint32s, edges): the values at `codes` one after the other, and where each starts, with the end of the last."""
    data = np.frombuffer(b"".join(values), "<u4")
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    starts = np.cumsum(sizes) - sizes
    edges = np.concatenate([[0], np.cumsum(sizes[codes])])
    # Narrow places where they fit.
    kind = np.int32 if max(edges[-1], len(data)) < 1 << 31 else np.int64
    at = np.repeat((starts[codes] - edges[:-1]).astype(kind), sizes[codes])
    at += np.arange(edges[-1], dtype=kind)
    return data.take(at), edges


class PretokenEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.bytes_as_characters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.openings = sorted({t["content"][:2] for t in spec["added_tokens"]})
        self.is_end = np.array(
            [(self.library.id_to_token(i) or "").endswith("</w>") for i in range(self.library.get_vocab_size())]
        )
        self._learn_characters(self._split_pattern(spec))
        # Where each spelled byte has an id as a last one, an id that ends a pre-token shows where the next one starts.
        self.ends_show = all(self.library.token_to_id(c + "</w>") is not None for c in pre_tokenizers.ByteLevel.alphabet())
        self.joined = Tokenizer(self.library.model)
        self.joined.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        self.cache = Generations(PRETOKEN_BYTES)
        # No pre-token of a plain text reaches over white space, so that the ids of a word are those of its pre-tokens.
        self.words = Generations(WORD_BYTES)

    @staticmethod
    def _split_pattern(spec: dict) -> str | None:
        """The split pattern if the file has the one layout the cache is proven for, else None."""
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        norms = (spec.get("normalizer") or {}).get("normalizers", [])
        ok = (
            [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and [n["type"] for n in norms] == ["NFC", "Replace", "Lowercase"]
            and spec["model"].get("end_of_word_suffix") == "</w>"
            and spec.get("post_processor") is None
        )
        return steps[0]["pattern"]["Regex"] if ok else None

    def _learn_characters(self, pattern: str | None) -> None:
        kinds: dict[str, list[str]] = {"letter": [], "number": [], "other": [], "space": []}
        split, normal = self.library.pre_tokenizer, self.library.normalizer
        for c in map(chr, CANDIDATES if pattern else ()):
            low = c.lower()
            pieces = [p for p, _ in split.pre_tokenize_str(low + low)]
            if not pieces or c.isspace():
                # A space joins nothing and is dropped on either side of a letter.
                if not pieces and c.isspace() and normal.normalize_str(f"a{c}b") == "a b":
                    kinds["space"].append(c)
                continue
            if len(low) != 1 or normal.normalize_str(f"a{c}b") != f"a{low}b":
                continue
            around = [p for p, _ in split.pre_tokenize_str(f"a{low}a")]
            kind = "letter" if len(around) == 1 else "number" if len(pieces) == 2 else "other"
            if len(around) in (1, 3):
                kinds[kind].append(c)
        every = {c for k in kinds.values() for c in k}
        # Lower-case forms must be known themselves.
        for k, chars in kinds.items():
            kinds[k] = [c for c in chars if c.lower() in every]
        every = {c for k in kinds.values() for c in k}

        def group(chars):
            return "".join(map(re.escape, sorted(set(chars))))

        self.odd = re.compile(f"[^{group(every)}]") if every else re.compile("(?s:.)")
        letters = set(kinds["letter"])
        self.by_words = letters.issuperset(ascii_letters) and set(kinds["space"]).issuperset(CUTS)
        self.letters_show = letters == {c for c in every if c.isalpha()}
        # The spelling of the characters beyond printable ASCII, byte by byte.
        self.spelling = {ord(c): self.bytes_as_characters.pre_tokenize_str(c)[0][0] for c in every if not (c.isascii() and c.isprintable())}
        if every:
            # Nothing before the letters' alternative starts with a letter, so that one may come first.
            first = pattern.split(r"[\p{L}]+")[0].split("|")
            own = pattern if any(a[:1].isalpha() or a[:1] in "[(." for a in first) else r"[\p{L}]+|" + pattern
            own = own.replace(r"[^\s\p{L}\p{N}]", f"[{group(kinds['other'])}]")
            own = own.replace(r"[\p{L}]", f"[{group(kinds['letter'])}]").replace(r"[\p{N}]", f"[{group(kinds['number'])}]")
            self.split = re.compile(own).findall

    def plain(self, text: str) -> bool:
        return not any(o in text for o in self.openings) and not self.odd.search(text)

    def pretokens(self, text: str) -> list[str]:
        return self.split(text.lower())

    def merge(self, token: str) -> bytes:
        """Ids of one pre-token as little-endian uint32, by the library's model: normaliser and splitter are done."""
        spelled = token if token.isascii() and token.isprintable() else token.translate(self.spelling)
        return array("I", [piece.id for piece in self.library.model.tokenize(spelled)]).tobytes()

    def _merged(self, tokens: list[str]) -> list[bytes]:
        """The same for many: one call of the model for the spellings between blanks."""
        if not self.ends_show:
            return list(map(self.merge, tokens))
        made = []
        for first in range(0, len(tokens), JOINED):
            some = tokens[first : first + JOINED]
            spelled = " ".join([t if t.isascii() and t.isprintable() else t.translate(self.spelling) for t in some])
            ids = np.array(self.joined.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * np.flatnonzero(self.is_end[ids]) + 4).tolist()
            if len(ends) == len(some):
                data = ids.tobytes()
                made += [data[a:b] for a, b in zip([0, *ends], ends)]
            else:
                made += map(self.merge, some)
        return made

    def _word_bytes(self, words: list[str]) -> list[bytes]:
        """Ids of words without white space of one byte, or ODD where the text has to go whole."""
        joined = "\n".join(words)
        plain = repeat(True) if self.plain(joined) else map(self.plain, words)
        # Characters of other words may be more than one in lower case, but never an end of line.
        lower, alone = joined.lower().split("\n"), self.letters_show
        # A word of letters is one pre-token.
        parts = [(w if alone and w.isalpha() else self.split(w)) if ok else None for ok, w in zip(plain, lower)]
        lists = [p for p in parts if type(p) is list]
        tokens = list(dict.fromkeys(chain([p for p in parts if type(p) is str], chain.from_iterable(lists))))
        ids = dict(zip(tokens, self.cache.values(tokens, self._merged)))
        return [ODD if p is None else ids[p] if type(p) is str else b"".join([ids[t] for t in p]) for p in parts]

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def id_bytes(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian uint32 ids of each text."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        if not self.by_words:
            return [self._whole(t) for t in texts.to_pylist()]
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        numbered = split.flatten().dictionary_encode()
        words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        values = pa.array(self.words.values(words, self._word_bytes), pa.large_binary())
        coded, rows = values.take(numbered.indices), split.offsets.to_numpy()
        whole = np.zeros(len(texts), bool)
        odd = pc.binary_length(values).to_numpy() == len(ODD)
        if odd.any():
            seen = np.concatenate([[0], np.cumsum(odd[numbered.indices.to_numpy()])])[rows]
            whole = seen[1:] > seen[:-1]
        _, edges, data = coded.buffers()
        ends = np.frombuffer(edges, "<i8")[rows].tolist()
        data = memoryview(data or b"")
        return [self._whole(texts[k].as_py()) if whole[k] else bytes(data[a:b]) for k, (a, b) in enumerate(zip(ends, ends[1:]))]


class PretokenCounter(PretokenEncoder):
    """Token counts. Vocabulary strings proven to encode alone as one token are counted without merging."""

    def __init__(self, path: str):
        super().__init__(path)
        self.whole = self.prove_whole_tokens()
        self.cache = Made(lambda token: len(self.merge(token)) // 4, PRETOKEN_BYTES)
        self.counted = Made(self._count_word, WORD_BYTES)

    def _count_word(self, word: str) -> int:
        tokens = self.split(word)
        rest = [t for t in tokens if t not in self.whole]
        return len(tokens) - len(rest) + sum(map(self.cache.__getitem__, rest))

    def prove_whole_tokens(self) -> frozenset[str]:
        """Pre-tokens the library itself encodes as the single token of that string."""
        from tokenizers import decoders

        spell = decoders.ByteLevel().decode
        words = {spell([self.library.id_to_token(i).removesuffix("</w>")]) for i in np.flatnonzero(self.is_end).tolist()}
        texts = [t for t in words if t and t == t.lower() and self.plain(t)]
        return frozenset(t for t in texts if self.split(t) == [t] and len(self._whole(t)) == 4)

    def counts(self, texts: list[str]) -> list[int]:
        get = self.counted.__getitem__
        return [sum(map(get, t.lower().split())) if self.plain(t) else len(self._whole(t)) // 4 for t in texts]


def shared(kind: type, path: str):
    """One encoder per process and file."""
    return held((kind.__name__, path), lambda: kind(path))


def text_groups(texts, limit: int = GROUP_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) groups of an Arrow string column; null is the empty text."""
    first, group, size = 0, [], 0
    for i, value in enumerate(texts):
        text = value.as_py() or ""
        if group and size + len(text) > limit:
            yield first, group
            first, group, size = i, [], 0
        group.append(text)
        size += len(text)
    if group:
        yield first, group


def byte_groups(texts: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) groups of an Arrow string column without nulls; a longer text is a group of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
    first = 0
    while first < len(texts):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield first, texts.slice(first, last - first)
        first = last
