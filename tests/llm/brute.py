"""Plain Python versions of the operators' contracts, straight from their definitions."""

from __future__ import annotations

import hashlib
import re

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def luhn(s: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits(s))):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text: str | None) -> list[tuple[str, int, int]]:
    kinds = (
        ("email", EMAIL, lambda v: True), ("ip", IP, lambda v: all(int(x) <= 255 for x in v.split("."))),
        ("card", CARD, lambda v: 13 <= len(digits(v)) <= 19 and luhn(v)), ("phone", PHONE, lambda v: 9 <= len(digits(v)) <= 15),
    )
    return [(k, *m.span()) for k, p, ok in kinds for m in p.finditer(text or "") if ok(m[0])]


def secrets(text: str | None) -> list[tuple[str, int, int]]:
    kinds = (("assign", ASSIGN, lambda m: len(m[2]) >= 6), ("access", ACCESS, lambda m: len(m[0]) >= 20), ("hex", HEX, lambda m: len(m[0]) >= 24))
    found = [(m.start(), n, k, m.end()) for n, (k, p, ok) in enumerate(kinds) for m in p.finditer(text or "") if ok(m)]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def shingles(text: str | None, n: int = 5) -> set[tuple[str, ...]]:
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
