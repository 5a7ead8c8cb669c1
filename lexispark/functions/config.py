"""Per-language settings read from Markdown, on the driver."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from lexispark.functions import constants as K


def sections(markdown: str) -> dict[str, list[str]]:
    """Lines below each second-level heading, by the heading's lower-cased text."""
    out: dict[str, list[str]] = {}
    now: list[str] = []
    for line in markdown.split("\n"):
        if line.startswith("## "):
            now = out.setdefault(line[3:].strip().lower(), [])
        else:
            now.append(line)
    return out


def to_java(pattern: str) -> str | None:
    """A Python pattern as a Java one; None if it doesn't compile or has a group that splitting would emit."""
    try:
        re.compile(pattern)
    except re.error:
        return None
    return pattern.replace("(?P<", "(?<")


def _setting(lines: list[str], key: str) -> str | None:
    for line in lines:
        found = re.fullmatch(rf"\s*-\s*{key}:\s*`(.+?)`\s*", line)
        if found:
            return to_java(found[1])
    return None


@dataclass(frozen=True)
class Phonology:
    valid_chars: str = ""
    confusion_pairs: list[tuple[str, str]] = field(default_factory=list)
    digital_text_trusted: bool = True
    entry_split: str | None = None
    entry_pattern: str | None = None
    headword_shape: str | None = None

    @staticmethod
    def parse(markdown: str, strict: bool = False) -> Phonology:
        """strict takes every character of the section; else comments and parentheses don't count."""
        parts = sections(markdown)
        chars = "\n".join(parts.get("valid characters", []))
        if not strict:
            chars = re.sub(r"<!--.*?-->|\([^)]*\)", "", chars, flags=re.DOTALL)
        pairs = [re.match(r"\s*-\s*`(.+?)`\s*→\s*`(.*?)`", x) for x in parts.get("ocr confusion pairs", [])]
        return Phonology(
            "".join(sorted({c for c in chars if not c.isspace()})),
            list({m[1]: m[2] for m in pairs if m}.items()),
            not any(re.search(r"trusted:\s*no", x) for x in parts.get("digital text layer", [])),
            _setting(parts.get("entry splitting", []), "split_before"),
            _setting(parts.get("entry pattern", []), "pattern"),
            _setting(parts.get("headword shape", []), "pattern"),
        )

    @staticmethod
    def load(path: str) -> Phonology:
        with open(path, encoding="utf-8") as f:
            return Phonology.parse(f.read())


@dataclass(frozen=True)
class Affixes:
    """Ordered (kind, name, Java pattern whose group 1 is the root)."""

    rules: tuple[tuple[str, str, str], ...]
    reduplications: tuple[str, ...] = tuple(K.REDUPLICATIONS)

    @staticmethod
    def default() -> Affixes:
        groups = (("prefix", K.PREFIXES), ("suffix", K.SUFFIXES), ("circumfix", K.CIRCUMFIXES))
        return Affixes(tuple((kind, name, p) for kind, table in groups for name, p in table.items()))

    @staticmethod
    def parse(markdown: str) -> Affixes:
        """Affixes of the Morphology section, lower-cased and taken literally; without any, the default ones."""
        found: dict[str, list[str]] = {"prefix": [], "suffix": [], "circumfix": []}
        for line in sections(markdown).get("morphology", []):
            item = re.match(r"-\s(prefix|suffix|circumfix)[^:]*:(.*)", line.strip().lower())
            if item:
                found[item[1]] += [x.strip() for x in item[2].split(",") if x.strip()]
        rules = []
        for name in found["prefix"]:
            stem = name.rstrip("-")
            if stem:
                rules.append(("prefix", stem, f"^{re.escape(stem)}(.+)$"))
        for name in found["suffix"]:
            stem = name.lstrip("-")
            if stem:
                rules.append(("suffix", f"-{stem}", f"^(.+){re.escape(stem)}$"))
        for name in found["circumfix"]:
            front, dots, back = name.partition("...")
            if dots and "..." not in back:
                rules.append(("circumfix", name, f"^{re.escape(front.strip('-'))}(.+){re.escape(back.strip('-'))}$"))
        return Affixes(tuple(rules)) if rules else Affixes.default()


@dataclass(frozen=True)
class Language:
    code: str
    name: str
    family: str = ""
    pivot_code: str = "ind"
    pivot_name: str = "Bahasa Indonesia"
    script: str = "latin_diacritic"
