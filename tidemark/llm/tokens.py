"""Token ids of texts inside tasks, word by word from a memory of the words already seen."""

from __future__ import annotations

import numpy as np

from tidemark.llm.common import worker_memory

#: Words a worker remembers at most; beyond, new words are encoded again when they return.
MEMORY = 1_000_000
#: Longer words are not remembered.
LONGEST = 48
#: Signs that are always apart from the letters before them, and where Latin letters end.
STOPS, LATIN_END = ".,", "\u0250"


class WordEncoder:
    """Encodes texts as the tokenizer does, as the bytes of an array of ``kind``.

    ``spaces`` says what the tokenizer makes of white space. ``"lead"``: a single space belongs to
    the word after it, so a text may be cut before each space. ``"drop"``: white space is dropped
    and parts words, so a text may be cut at each space or line end. ``None``: texts are encoded
    whole. A text with a space next to other white space is encoded whole under ``"lead"``.
    Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, spaces: str | None):
        from tokenizers import Tokenizer

        self.spaces = spaces
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 2**16 else "<u4"
        self.size = int(self.kind[-1])
        # The ids of a word, or False if it has none of its own.
        self.memory: dict[str, bytes | bool] = {}

    @staticmethod
    def of_worker(path: str, spaces: str | None) -> WordEncoder:
        return worker_memory(("encoder", path, spaces), lambda: WordEncoder(path, spaces))

    def as_bytes(self, ids) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes()

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [self.as_bytes(x.ids) for x in found]

    def _learn(self, words: list[str]) -> dict[str, bytes | bool]:
        """Ids of new words.

        Under ``"lead"`` a word stands for itself after a space, or after a line end if it begins
        with one. A Latin word before a full stop or comma is learnt once, with and without it.
        """
        lead, known, learnt = self.spaces == "lead", self.memory, {}
        plain, marked, first, stemmed = set(), [], [], []
        for w in words:
            body = w[1:] if lead and w[:1] == "\n" else w
            # Words that hold white space at an end stood beside more white space.
            if lead and (not body or body[0].isspace() or body[-1].isspace()):
                learnt[w] = False
            elif body is not w:
                (marked if "\n" in body else first).append(w)
            elif "\n" in w or "\x01" in w:
                marked.append(w)
            elif w[-1:] in STOPS and w[:-1].isalpha() and max(w) < LATIN_END:
                stemmed.append(w)
                if w[:-1] not in known:
                    plain.add(w[:-1])
            else:
                plain.add(w)
        gap = " " if lead else ""
        alone = [w if lead and w[0] == "\n" else gap + w for w in marked]
        learnt.update(zip(marked, self._ids(alone)))
        plain = list(plain)
        learnt.update(zip(plain, self._joined(plain, gap)))
        if first:
            (end,) = self._ids(["\n"])
            learnt.update((w, end + ids) for w, ids in zip(first, self._joined([w[1:] for w in first], "")))
        if stemmed:
            stops = dict(zip(STOPS, self._ids(list(STOPS))))
            for w in stemmed:
                stem = w[:-1]
                learnt[w] = (known[stem] if stem in known else learnt[stem]) + stops[w[-1]]
        return learnt

    def _joined(self, words: list[str], gap: str) -> list[bytes]:
        """Many words are encoded as one text, with a mark between them that they do not hold."""
        mark = "\n" if self.spaces == "lead" else " \x01 "
        (mark_id,) = np.frombuffer(self._ids([mark.strip(" ")])[0], self.kind)
        out = []
        for i in range(0, len(words), 512):
            part = words[i : i + 512]
            raw = self._ids([mark.strip(" ") + "".join(f"{gap}{w}{mark}" for w in part)])[0]
            ends = np.flatnonzero(np.frombuffer(raw, self.kind) == mark_id)
            if len(ends) != len(part) + 1:  # the mark is not kept apart by this tokenizer
                out += self._ids([gap + w for w in part])
                continue
            at = (self.size * ends).tolist()
            out += [raw[a + self.size : b] for a, b in zip(at, at[1:])]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.spaces is None:
            return self._ids(texts)
        lead = self.spaces == "lead"
        parts = [t.replace("\n", " \n" if lead else " ").split(" ") for t in texts]
        heads = self._ids([p.pop(0) for p in parts]) if lead else [b""] * len(parts)
        recall = self.memory.get
        found = [list(map(recall, words)) for words in parts]
        gaps = []
        for words, ids in zip(parts, found):
            at = -1
            for _ in range(ids.count(None)):
                at = ids.index(None, at + 1)
                gaps.append((ids, at, words[at]))
        if gaps:
            learnt = self._learn(list({w for _, _, w in gaps}))
            for ids, at, w in gaps:
                ids[at] = learnt[w]
            if len(self.memory) < MEMORY:
                self.memory.update((w, i) for w, i in learnt.items() if len(w) <= LONGEST)
        return [
            self._ids([text])[0] if False in ids else head + b"".join(ids)
            for text, head, ids in zip(texts, heads, found)
        ]
