"""Encoding with a word cache around a public tokenizer.

Both supported tokenizers cut a text into words before they merge pieces, and no piece crosses a word.  So the ids of
a text are the ids of its words in order, and a word has to be encoded once only.  Words of letters are merged by the
tokenizer's model, one with a mark behind it is the word and the mark, and all others are encoded together, as one text;
the byte lengths of the returned pieces tell where each word ends.  The ids are those of the tokenizer itself on the
whole text, added tokens in it included; the tests compare them.

The cache has two generations.  When the younger is full it becomes the older, whose words come back as they are met, so
frequent words stay, rare ones go, and the number of words that a worker holds is bounded.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array

import numpy as np

#: The characters that Unicode calls white space.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Python's split() takes these for white space as well, Unicode does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
BYTE_WORDS = re.compile(f"[{WHITE}]+(?=[{WHITE}][^{WHITE}])|[{WHITE}]?[^{WHITE}]+|[{WHITE}]+")
PLAIN_WORDS = re.compile(f"[^{WHITE}]+")
#: A comma or full stop beside another sign belongs to one piece with it.
TOUCHING = re.compile(r"[,.](?:(?=[^\w\s]|_)|(?<=[^\w\s].)|(?<=_.))")
DOUBLE = ("  ", " \n", "\n ", "\n\n")
#: Before words that are cached as they stand; other words never begin with it.
AS_IT_IS = "\n\n"
#: Marks that are a piece of their own behind a word of letters, and letters whose case and form are beyond doubt below.
MARKS = frozenset(",.;:!?")
PLAIN_LETTERS = "\u0530"
LONG_WORD = 1000
#: Words that a Python worker remembers: some 200 bytes each.
MAX_WORDS = 1_000_000
JOINED = 4000


def byte_signs() -> dict[int, str]:
    """The sign that byte-level vocabularies write for each byte: itself if it is printable, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class CachedEncoder:
    """Ids of texts; ``max_words`` bounds the cache, both generations together."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        before = said.get("pre_tokenizer") or {}
        added = said.get("added_tokens") or []
        self.kind = "plain"
        if not any(t[x] for t in added for x in ("normalized", "lstrip", "rstrip", "single_word")):
            if before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex") and not said.get("normalizer"):
                self.kind = "byte"
            elif said["model"].get("end_of_word_suffix") == "</w>" and "Lowercase" in json.dumps(said.get("normalizer")):
                self.kind = "word"
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.width, self.code = ("<u2", "H") if self.size <= 1 << 16 else ("<u4", "I")
        self.length = np.zeros(self.size, np.int64)
        for piece, i in vocab.items():
            self.length[i] = len(piece) - 4 if self.kind == "word" and piece.endswith("</w>") and len(piece) > 4 else len(piece)
        self.added = re.compile("|".join(re.escape(t["content"]) for t in added) or r"(?!)")
        self.pinned = {AS_IT_IS + t["content"]: np.array([t["id"]], self.width).tobytes() for t in added}
        if self.kind != "plain":  # added tokens are cut out of texts before; in words their signs are signs
            self.tokenizer.encode_special_tokens = True
        self.signs = byte_signs()
        self.prefix = self.signs[32] if self.kind == "byte" else ""
        self.max_words = max_words
        self.young, self.old = dict(self.pinned), {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as the tokenizer gives them without special tokens around it."""
        if self.kind == "plain":
            return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if not texts:
            return []
        words, heads = zip(*map(self._cut, texts))
        self._meet(set().union(*words).difference(self.young))
        get = self.young.__getitem__
        out = [np.frombuffer(b"".join(map(get, w)), self.width)[h:].astype("<u4") for w, h in zip(words, heads)]
        if len(self.young) * 2 > self.max_words:
            self.young, self.old = dict(self.pinned), self.young
        return out

    def forget(self) -> None:
        """Let go of all words; vocabulary and tokenizer stay."""
        self.young, self.old = dict(self.pinned), {}

    def _cut(self, text: str) -> tuple[list[str], int]:
        """Words of a text, and how many ids of the first one are cut off again."""
        cut = self._cut_byte if self.kind == "byte" else self._cut_word
        if self.added.search(text) is None:
            return cut(text)
        words: list[str] = []
        at = 0
        for m in self.added.finditer(text):
            words += self._pieces(text[at : m.start()])
            words.append(AS_IT_IS + m[0])
            at = m.end()
        return words + self._pieces(text[at:]), 0

    def _pieces(self, part: str) -> list[str]:
        return [AS_IT_IS + w for w in BYTE_WORDS.findall(part)] if self.kind == "byte" else self._cut_word(part)[0]

    @staticmethod
    def _cut_byte(text: str) -> tuple[list[str], int]:
        """Words without their blank; the first stands after a line feed, whose id is cut off again."""
        single = not any(two in text for two in DOUBLE) and text.strip() == text
        if single and text.count(" ") + text.count("\n") + 1 == len(text.split()):
            return ("\n" + text).replace("\n", " \n").split(" ")[1:], 1
        return [AS_IT_IS + w for w in BYTE_WORDS.findall(text)], 0

    @staticmethod
    def _cut_word(text: str) -> tuple[list[str], int]:
        if SEPARATORS.search(text):
            return PLAIN_WORDS.findall(text), 0
        low = text.lower()  # some marks join or change places only beside the small letter: such texts are left to the tokenizer
        if text.isascii() or "Σ" not in text and unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low):
            text = low
            if not TOUCHING.search(text):
                text = text.replace(",", " , ").replace(".", " . ")
        return text.split(), 0

    def _meet(self, words: set[str]) -> None:
        """Put words into the younger generation: from the older one, from their parts, or from the tokenizer."""
        young, old = self.young, self.old
        strange, marked = [], []
        for word in words:
            if (ids := old.get(word)) is not None:
                young[word] = ids
            elif word[-1:] in MARKS and word[:-1].isalpha():
                marked.append(word)
            elif self._plain(word):
                young[word] = self._merge(word)
            else:
                strange.append(word)
        for word in marked:
            base, mark = word[:-1], AS_IT_IS + word[-1]
            if not self._plain(base):
                strange.append(word)
                continue
            if (ids := young.get(base) or old.get(base)) is None:
                ids = self._merge(base)
            young[base] = ids
            if mark not in young:
                young[mark] = self._each([word[-1]])[0]
            young[word] = ids + young[mark]
        for k in range(0, len(strange), JOINED):
            self._learn(strange[k : k + JOINED])

    def _plain(self, word: str) -> bool:
        """Whether a word is letters that all of Unicode's versions agree on."""
        if not word.isalpha() or len(word) > LONG_WORD:
            return False
        if self.kind == "word" and word != word.lower():
            return False
        return word.isascii() or max(word) < PLAIN_LETTERS and unicodedata.is_normalized("NFC", word)

    def _merge(self, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.signs)
        return array(self.code, [t.id for t in self.model.tokenize(self.prefix + word)]).tobytes()

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.width).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        if self.kind == "byte":
            alone = [w for w in words if w.startswith(AS_IT_IS) or len(w) > LONG_WORD]
            words = [w for w in words if not w.startswith(AS_IT_IS) and len(w) <= LONG_WORD]
            texts = [self._as_text(w) for w in words]
            joined, ends = "".join(texts), np.cumsum([len(t.encode()) for t in texts])
        else:
            alone = [w for w in words if len(w) > LONG_WORD]
            words = [w for w in words if len(w) <= LONG_WORD]
            joined, ends = " ".join(words), np.cumsum([len(unicodedata.normalize("NFC", w).lower().encode()) for w in words])
        if words:
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.width)
            upto = np.cumsum(self.length[ids])
            last = np.searchsorted(upto, ends)
            if len(ids) and last[-1] == len(ids) - 1 and (upto[last] == ends).all():
                raw, start, size = ids.tobytes(), 0, ids.itemsize
                for word, end in zip(words, ((last + 1) * size).tolist()):
                    self.young[word] = raw[start:end]
                    start = end
            else:  # lengths that do not add up: word by word
                alone = alone + words
        if alone:
            self.young.update(zip(alone, self._each([self._as_text(w) for w in alone])))

    def _as_text(self, word: str) -> str:
        if self.kind == "word" or word[0] == "\n":
            return word.removeprefix(AS_IT_IS)
        return f" {word}"


_encoders: dict[str, CachedEncoder] = {}


def encoder(path: str, max_words: int = MAX_WORDS) -> CachedEncoder:
    """One for each Python worker, kept over tasks; so are its words, unless a task lets go of them."""
    if path not in _encoders:
        _encoders[path] = CachedEncoder(path)
    _encoders[path].max_words = max_words
    return _encoders[path]


def slices(sizes: list[int], most: int = 2_000_000):
    """Ranges of a batch of about ``most`` characters each; ``sizes``: characters of each text."""
    start = total = 0
    for k, size in enumerate(sizes):
        total += size
        if total >= most:
            yield start, k + 1
            start, total = k + 1, 0
    if start < len(sizes):
        yield start, len(sizes)
