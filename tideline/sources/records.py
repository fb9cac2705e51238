"""Where a delimited record ends, and what its fields are: quotes may hold separators and line breaks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Dialect:
    """How fields are set apart, in bytes of an encoding that keeps ASCII."""

    sep: bytes = b","
    quote: bytes = b'"'
    escape: bytes = b'"'

    @classmethod
    def of(cls, sep: str, options: dict, encoding: str) -> Dialect:
        quote = str(options.get("quote", '"'))
        return cls(sep.encode(encoding), quote.encode(encoding), str(options.get("escape", '"')).encode(encoding))

    def _closing(self, line: bytes, start: int) -> int:
        """The quote that ends a quoted value, from ``start`` inside it; -1 if the line does not hold it."""
        at = line.find(self.quote, start)
        while at >= 0:
            if self.escape == self.quote:
                if not line.startswith(self.quote, at + 1):
                    return at
                at = line.find(self.quote, at + 2)
            else:
                before = at
                while self.escape and before > start and line.startswith(self.escape, before - 1):
                    before -= 1
                if (at - before) % 2 == 0:
                    return at
                at = line.find(self.quote, at + 1)
        return -1

    def open_after(self, line: bytes, inside: bool) -> bool:
        """Whether a quoted value is open at the end of a line that starts inside one or not.

        A quote opens a value only as its first character; elsewhere it is text.
        """
        if not self.quote or self.quote not in line:
            return inside
        at = 0
        while True:
            if inside:
                at = self._closing(line, at)
                if at < 0:
                    return True
                inside = False
                at = line.find(self.sep, at + 1)
                if at < 0:
                    return False
                at += len(self.sep)
            elif line.startswith(self.quote, at):
                inside, at = True, at + 1
            else:
                at = line.find(self.sep + self.quote, at)
                if at < 0:
                    return False
                at += len(self.sep)

    def fields(self, record: bytes) -> list[bytes]:
        """The values of one record, without their quotes."""
        out, at = [], 0
        while True:
            if self.quote and record.startswith(self.quote, at):
                end = self._closing(record, at + 1)
                end = len(record) if end < 0 else end
                value = record[at + 1 : end].replace(self.escape + self.quote, self.quote) if self.escape else record[at + 1 : end]
                following = record.find(self.sep, end + 1)
                rest = record[end + 1 : following if following >= 0 else len(record)]
                # text after the closing quote: the value is taken as it stands
                value = record[at : end + 1] + rest if rest.strip() else value
            else:
                following = record.find(self.sep, at)
                value = record[at : following if following >= 0 else len(record)]
            out.append(value)
            if following < 0:
                return out
            at = following + len(self.sep)


def header_names(values: Sequence[str]) -> list[str]:
    """Column names of a header as Spark's reader gives them: empty ones by place, repeated ones numbered."""
    lower = [v.lower() for v in values]
    repeated = {v for v in lower if lower.count(v) > 1}
    return [f"_c{k}" if not v else f"{v}{k}" if v.lower() in repeated else v for k, v in enumerate(values)]
