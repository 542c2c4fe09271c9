"""Exact encoding with the tokenizers library, sped up by encoding each piece between spaces once.

No merge of these vocabularies crosses a space followed by a non-space, so a text's ids are the ids of its pieces in order.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fjordlake.llm.common import blocks_by_size, kept

#: White space, under any of the definitions in use, other than space and line feed.
ODD_SPACE = re.compile(r"[^\S \n]")
#: Marks that may follow a word and are pieces of their own.
MARKS = ".,;:!?&%$#*|)"
#: Pieces that a worker keeps twice over, about 200 bytes each, and characters that it encodes at a time.
CACHE = 350_000
BLOCK = 8_000_000


class PieceEncoder:
    """Ids of whole texts as little-endian unsigned integers of `width` bytes.

    drops_space: the vocabulary ignores white space, so any space or line feed is a cut. Otherwise a piece stands for
    itself behind a space, or, if it begins with a line feed, for itself."""

    def __init__(self, path: str, drops_space: bool, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.drops_space = drops_space
        n = self.library.get_vocab_size()
        self.width = 2 if n <= 1 << 16 else 4
        self.type = np.dtype("<u2" if self.width == 2 else "<u4")
        self.most = cache
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the last full cache; what is used of it again moves on
        self.marks: dict[str, bytes] = {}
        self.line_feed = np.frombuffer(self.encode_each(["\n"])[0], self.type)
        names = [self.library.id_to_token(i) or "" for i in range(n)]
        self.begins = np.array([x.startswith("Ġ") for x in names])
        self.ends = np.array([x.endswith("</w>") for x in names])

    def encode_each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.type).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str], lead: str) -> list[bytes]:
        """Words of letters only, behind `lead`: many in one text, taken apart where each begins (or ends)."""
        out: list[bytes] = []
        for at in range(0, len(words), 1000):
            some = words[at : at + 1000]
            ids = np.array(self.library.encode_batch_fast([lead + lead.join(some)], add_special_tokens=False)[0].ids, self.type)
            if self.drops_space:
                bounds = np.concatenate(([0], np.flatnonzero(self.ends[ids]) + 1))
            else:
                bounds = np.append(np.flatnonzero(ids == self.line_feed[0] if lead == "\n" else self.begins[ids]), len(ids))
            if len(bounds) == len(some) + 1 and bounds[0] == 0 and bounds[-1] == len(ids):  # each word has at least one such place
                raw, cuts = ids.tobytes(), (bounds * self.width).tolist()
                out += [raw[a:b] for a, b in zip(cuts, cuts[1:])]
            else:
                out += self.encode_each([lead + w for w in some])
        return out

    def _learn(self, missing: list[str]) -> dict[str, bytes]:
        """Ids of pieces that the cache lacks; a word with marks behind it is put together from both."""
        stems: dict[str, dict[str, None]] = {" ": {}, "\n": {}}
        put_together, others, found = [], [], {}
        for p in missing:
            stem = p.rstrip(MARKS)
            lead = "\n" if stem[:1] == "\n" and not self.drops_space else " "
            word = stem[1:] if lead == "\n" else stem
            if not word.isalpha() or (lead == "\n" and len(self.line_feed) != 1):
                others.append(p)
                continue
            known = self.cache.get(stem) or self.older.get(stem)
            if known is not None:
                found[stem] = known
            else:
                stems[lead][word] = None
            if len(stem) < len(p):
                put_together.append((p, stem, p[len(stem) :]))
        for lead, words in stems.items():
            if words:
                keys = [lead + w for w in words] if lead == "\n" else list(words)
                found.update(zip(keys, self._encode_words(list(words), lead)))
        new = list({mark for _, _, mark in put_together if mark not in self.marks})
        self.marks.update(zip(new, self.encode_each(new)))
        for p, stem, mark in put_together:
            found[p] = found[stem] + self.marks[mark]
        found.update(zip(others, self.encode_each([p if self.drops_space or p[:1] == "\n" else " " + p for p in others])))
        return found

    def _keep(self, found: dict[str, bytes]) -> None:
        if len(self.cache) + len(found) > self.most:
            self.older, self.cache = self.cache, {}
        self.cache.update(found)

    @staticmethod
    def _simple(text: str) -> bool:
        """Whether each white-space character is a space or a line feed between two others."""
        if not text or text[0].isspace() or text[-1].isspace() or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return False
        return not ODD_SPACE.search(text)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; a block's distinct pieces are looked up once and their ids gathered in place."""
        out = [b""] * len(texts)
        for part in blocks_by_size([len(t) for t in texts], BLOCK):
            at, ready = [], []
            for i in range(part.start, part.stop):
                if self.drops_space:
                    at.append(i)
                    ready.append(texts[i].replace("\n", " "))
                elif self._simple(texts[i]):
                    at.append(i)
                    ready.append(("\n" + texts[i]).replace("\n", " \n"))
                else:
                    out[i] = self.encode_each([texts[i]])[0]
            for i, ids in zip(at, self._gather(ready) if ready else ()):
                out[i] = ids
        return out

    def _gather(self, ready: list[str]) -> list[bytes]:
        lists = pc.split_pattern(pa.array(ready, pa.string()), " ")
        words = pc.dictionary_encode(lists.flatten())
        pieces = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        if not self.drops_space:
            self.cache[""] = b""  # what precedes the first piece
        ids = list(map(self.cache.get, pieces))
        if missing := [p for p, x in zip(pieces, ids) if x is None]:
            found = {p: x for p in missing if (x := self.older.get(p)) is not None}
            found |= self._learn([p for p in missing if p not in found])
            ids = [found[p] if x is None else x for p, x in zip(pieces, ids)]
            self._keep(found)
        # every piece's ids one behind the other; offsets of 64 bits, since one text may be of any length
        taken = pa.array(ids, pa.large_binary()).take(words.indices)
        ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, 8 * taken.offset)
        flat = memoryview(taken.buffers()[2] or b"")
        cuts = ends[lists.offsets.to_numpy()].tolist()
        skip = 0 if self.drops_space else len(self.line_feed) * self.width
        return [bytes(flat[a + skip : b]) for a, b in zip(cuts, cuts[1:])]


def encoder(path: str, drops_space: bool, cache: int = CACHE) -> PieceEncoder:
    """One for each Python worker, kept while its tasks encode."""
    return kept((path, drops_space, cache), lambda: PieceEncoder(path, drops_space, cache))
