"""Repairs of LaTeX formulas as recognisers write them; plain functions on one formula."""

from __future__ import annotations

import re

_TOKEN = re.compile(r"\\[A-Za-z]+|\\.|[{}]|[^\\{}]+", re.S)
_LEFT_RIGHT = re.compile(r"\\(left|right)(?![A-Za-z])\s*(\\[A-Za-z]+|\\.|.)?", re.S)
#: Commands that common renderers lack, and what stands for them.
UNSUPPORTED = ("lefteqn", "boldmath", "ensuremath", "centering", "textsubscript", "sides", "textsl", "textcent", "emph", "protect", "null")
REPLACED = {r"\up": r"\mathrm", r"\upmu": r"\mu", r"\hdots": r"\ldots", r"\dotsint": r"\int", r"\textunderscore": r"\_", r"\vline": "|", r"\ensuremath": ""}


def balanced_braces(formula: str) -> str:
    """Without braces that have no partner."""
    parts = _TOKEN.findall(formula)
    open_, drop = [], set()
    for i, t in enumerate(parts):
        if t == "{":
            open_.append(i)
        elif t == "}":
            if open_:
                open_.pop()
            else:
                drop.add(i)
    drop |= set(open_)
    return "".join(t for i, t in enumerate(parts) if i not in drop)


def paired_delimiters(formula: str) -> str:
    r"""``\left`` and ``\right`` only where each group holds as many of both, in order; else the delimiters stay plain."""
    depth, stack, lone = 0, [], []
    i = 0
    while i < len(formula):
        m = _LEFT_RIGHT.match(formula, i)
        if m:
            if m.group(1) == "left":
                stack.append((depth, m.start()))
            elif stack and stack[-1][0] == depth:
                stack.pop()
            else:
                lone.append(m.start())
            i = m.start() + len(m.group(1)) + 1
            continue
        if formula[i] == "\\":
            i += 2
            continue
        if formula[i] == "{":
            depth += 1
        elif formula[i] == "}":
            while stack and stack[-1][0] >= depth:
                lone.append(stack.pop()[1])
            depth -= 1
        i += 1
    lone += [s for _, s in stack]
    for at in sorted(lone, reverse=True):
        word = 5 if formula.startswith("\\left", at) else 6
        rest = formula[at + word :].lstrip()
        # "\left." stands for nothing
        formula = formula[:at] + (rest[1:] if rest.startswith(".") else rest)
    return formula


def spaced_commands(formula: str) -> str:
    """A blank after a command that runs into a letter or digit behind it, kept as it was where it is one word."""
    return re.sub(r"(\\[,:;! ])(?=[A-Za-z0-9])", r"\1 ", formula)


def tightened(formula: str) -> str:
    """Without blanks that mean nothing: between single characters, not behind a command before a letter."""
    keep: list[str] = []

    def hold(m: re.Match) -> str:
        keep.append(m.group())
        return f"\x00{len(keep) - 1}\x00"

    s = re.sub(r"\\(?:operatorname|mathrm|text|mathbf)\s*\*?\s*\{[^{}]*\}", hold, formula)
    s = re.sub(r"(\\[A-Za-z]+)\s+(?=[A-Za-z])", lambda m: m.group(1) + "\x01", s)
    s = re.sub(r"(?<!\\)\s+", "", s).replace("\x01", " ")
    return re.sub("\x00(\\d+)\x00", lambda m: re.sub(r"\s+", " ", keep[int(m.group(1))]), s)


def cleaned(formula: str | None) -> str | None:
    """All repairs in order; null stays null."""
    if formula is None:
        return None
    s = formula.strip()
    for name in UNSUPPORTED:
        s = re.sub(rf"\\{name}(?![A-Za-z])", "", s)
    for old, new in REPLACED.items():
        s = re.sub(re.escape(old) + r"(?![A-Za-z])", lambda _, n=new: n, s)
    s = paired_delimiters(balanced_braces(s))
    return spaced_commands(s).strip()
