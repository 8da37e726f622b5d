"""Values of the parts of texts between single spaces, kept in a bounded table of the task.

Byte-level pre-tokenizers cut before every single space that stands between two other
characters, so such parts can be encoded alone, each with the space before it.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

#: Entries a task's table may hold before it starts again.
TABLE_ENTRIES = 800_000


class PartTable:
    """`values` encodes many short texts at once; `specials` are texts of special tokens."""

    def __init__(self, values: Callable[[list[str]], list], specials: list[str]):
        self.values, self.specials = values, specials
        self.inner: dict[str, Any] = {}
        self.head: dict[str, Any] = {}

    def _learn(self, table: dict[str, Any], new: set[str], before: str) -> None:
        """White space beside a space may change the cut: such parts get None."""
        table.update(dict.fromkeys(new))
        plain = [p for p in new if p and not p[0].isspace() and not p[-1].isspace()]
        table.update(zip(plain, self.values([before + p for p in plain]), strict=True))

    def look_up(self, texts: list[str]) -> list[list | None]:
        """The values of each text's parts; None where the text must be encoded as a whole."""
        if len(self.inner) + len(self.head) > TABLE_ENTRIES:
            self.inner, self.head = {}, {}
        cut = [t.split(" ") for t in texts]
        self._learn(self.head, {c[0] for c in cut} - self.head.keys(), "")
        self._learn(self.inner, {p for c in cut for p in c[1:]} - self.inner.keys(), " ")
        inner, out = self.inner.__getitem__, []
        for text, (head, *rest) in zip(texts, cut, strict=True):
            found = [self.head[head], *map(inner, rest)] if head else [*map(inner, rest)]
            whole = None in found or any(s in text for s in self.specials)
            out.append(None if whole else found)
        return out
