"""Token ids of whole texts, and the pieces a document is cut into for packing."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np

from shiplog.llm.token_counts import PRE_TOKEN, byte_letters

IDS = np.dtype("<u4")
#: Bytes between two spaces from which on the tokenizers library encodes a text.
LONG_PART = 2_000
#: PRE_TOKEN for texts in which no two blanks meet.
SINGLE_BLANKS = PRE_TOKEN.replace(r"|\s+(?!\S)", "")
TWO_BLANKS = re.compile(r"\s\s")
#: Blanks for Python, not for the pattern.
SEPARATORS = re.compile("[\x1c-\x1f]")
AROUND_RUNS = re.compile(r"(?<=\S)(?=\s\s)|(?<=\s)(?=\s\S)")


class Encoder:
    """Ids as the tokenizers library gives them, without added special tokens.

    Texts go through tiktoken, loaded with the same vocabulary, several times as fast for the same
    ids; those with the text of a special token or with very long parts go through the tokenizers
    library itself, as does everything if the ids do not follow the order of the merges.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.specials = [t.content for t in added.values()]
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = {t: i for t, i in model["vocab"].items() if t not in self.specials}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [vocab[a + b] for a, b in pairs]
        self.plain = None
        if all(a < b for a, b in zip(merged, merged[1:], strict=False)):
            byte = {c: b for b, c in enumerate(byte_letters())}
            ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items()}
            self.plain, self.single = (
                tiktoken.Encoding("texts", pat_str=p, mergeable_ranks=ranks, special_tokens={})
                for p in (PRE_TOKEN, SINGLE_BLANKS)
            )

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, IDS).tobytes()

    def is_plain(self, text: str) -> bool:
        if self.plain is None or any(s in text for s in self.specials):
            return False
        if len(text) <= LONG_PART:
            return True
        data = np.frombuffer(text.encode(), np.uint8)
        spaces = np.flatnonzero(data == ord(" "))
        return bool(np.diff(spaces, prepend=-1, append=len(data)).max() <= LONG_PART)

    def ordinary(self, text: str) -> list[int]:
        """Where no two blanks meet, the pattern needs no look ahead, which makes it fast; a run
        of blanks is a pre-token but for its last one, so that texts may be cut around it."""
        if not TWO_BLANKS.search(text):
            return self.single.encode_ordinary(text)
        if SEPARATORS.search(text):
            return self.plain.encode_ordinary(text)
        return [i for part in AROUND_RUNS.split(text) for i in self.single.encode_ordinary(part)]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            if self.is_plain(text):
                yield np.array(self.ordinary(text), IDS).tobytes()
            else:
                yield self.whole(text)


def pieces(ids: bytes, end: int, capacity: int) -> Iterator[tuple[int, int, bytes]]:
    """(start, document's ids, bytes of the piece's ids): the ids and `end`, cut into full
    windows and a rest."""
    ids += np.array([end], IDS).tobytes()
    total, step = len(ids) // IDS.itemsize, capacity * IDS.itemsize
    for at in range(0, len(ids), step):
        yield at // IDS.itemsize, total, ids[at : at + step]
