"""Office formulas (OMML) as LaTeX: one dispatcher over the elements of a formula."""

from __future__ import annotations

import xml.etree.ElementTree as ET

M = "{http://schemas.openxmlformats.org/officeDocument/2006/math}"

# Characters of a formula and their commands.
SIGNS = {
    "α": r"\alpha", "β": r"\beta", "γ": r"\gamma", "δ": r"\delta", "ε": r"\epsilon", "θ": r"\theta", "λ": r"\lambda", "μ": r"\mu", "π": r"\pi", "ρ": r"\rho", "σ": r"\sigma", "τ": r"\tau", "φ": r"\phi", "ω": r"\omega",
    "Γ": r"\Gamma", "Δ": r"\Delta", "Θ": r"\Theta", "Λ": r"\Lambda", "Π": r"\Pi", "Σ": r"\Sigma", "Φ": r"\Phi", "Ω": r"\Omega",
    "±": r"\pm", "×": r"\times", "÷": r"\div", "·": r"\cdot", "≤": r"\leq", "≥": r"\geq", "≠": r"\neq", "≈": r"\approx", "∞": r"\infty", "→": r"\rightarrow", "←": r"\leftarrow", "∈": r"\in", "∂": r"\partial", "∇": r"\nabla", "√": r"\surd", "…": r"\ldots",
}
OPERATORS = {"∑": r"\sum", "∏": r"\prod", "∫": r"\int", "∬": r"\iint", "∭": r"\iiint", "∮": r"\oint", "⋃": r"\bigcup", "⋂": r"\bigcap", "⋁": r"\bigvee", "⋀": r"\bigwedge", "∐": r"\coprod"}
ACCENTS = {"̀": r"\grave", "́": r"\acute", "̂": r"\hat", "̃": r"\tilde", "̄": r"\bar", "̅": r"\overline", "̆": r"\breve", "̇": r"\dot", "̈": r"\ddot", "̌": r"\check", "⃗": r"\vec", "⏞": r"\overbrace", "⏟": r"\underbrace"}
FUNCTIONS = {"sin", "cos", "tan", "cot", "sec", "csc", "arcsin", "arccos", "arctan", "sinh", "cosh", "tanh", "log", "ln", "exp", "det", "dim", "max", "min", "sup", "inf", "lim", "gcd", "arg", "deg", "ker", "hom"}
LIMITS = {"lim", "max", "min", "sup", "inf"}
DELIMITERS = {"{": r"\{", "}": r"\}", "⟨": r"\langle", "⟩": r"\rangle", "|": "|", "‖": r"\|", "⌊": r"\lfloor", "⌋": r"\rfloor", "⌈": r"\lceil", "⌉": r"\rceil", "": "."}


def _local(e: ET.Element) -> str:
    return e.tag.rsplit("}", 1)[-1]


def _value(parent: ET.Element | None, name: str) -> str | None:
    """The value of a property; "" where the property is there without one."""
    found = parent.find(M + name) if parent is not None else None
    return None if found is None else found.get(M + "val", "")


def _all(e: ET.Element | None) -> str:
    return "" if e is None else "".join(latex(c) for c in e if not _local(c).endswith("Pr"))


def _part(e: ET.Element, name: str) -> str:
    return _all(e.find(M + name))


def _text(e: ET.Element) -> str:
    raw = "".join(t.text or "" for t in e.iter(M + "t"))
    out = ""
    for c in raw:
        sign = SIGNS.get(c) or OPERATORS.get(c)
        out += sign + " " if sign else "\\" + c if c in "#%&$_{}" else c
    return out


def latex(e: ET.Element) -> str:
    """LaTeX of an element and what is in it; unknown elements give their contents."""
    kind = _local(e)
    props = e.find(M + kind + "Pr")
    if kind == "r":
        return _text(e)
    if kind == "f":
        num, den = _part(e, "num"), _part(e, "den")
        form = _value(props, "type")
        return f"{num}/{den}" if form in ("lin", "skw") else f"\\genfrac{{}}{{}}{{0pt}}{{}}{{{num}}}{{{den}}}" if form == "noBar" else f"\\frac{{{num}}}{{{den}}}"
    if kind == "sSup":
        return f"{_part(e, 'e')}^{{{_part(e, 'sup')}}}"
    if kind == "sSub":
        return f"{_part(e, 'e')}_{{{_part(e, 'sub')}}}"
    if kind == "sSubSup":
        return f"{_part(e, 'e')}_{{{_part(e, 'sub')}}}^{{{_part(e, 'sup')}}}"
    if kind == "sPre":
        return ""  # scripts before their base have no form here
    if kind == "rad":
        degree, body = _part(e, "deg"), _part(e, "e")
        return f"\\sqrt[{degree}]{{{body}}}" if degree else f"\\sqrt{{{body}}}"
    if kind == "d":
        left, right = _value(props, "begChr"), _value(props, "endChr")
        mark = lambda v, default: DELIMITERS.get(default if v is None else v, default if v is None else v)
        separator = _value(props, "sepChr") or "|"
        return f"\\left{mark(left, '(')}{separator.join(_all(x) for x in e.findall(M + 'e'))}\\right{mark(right, ')')}"
    if kind == "nary":
        sign = OPERATORS.get(_value(props, "chr") or "∫", r"\int")
        sub, sup = _part(e, "sub"), _part(e, "sup")
        return sign + (f"_{{{sub}}}" if sub else "") + (f"^{{{sup}}}" if sup else "") + " " + _part(e, "e")
    if kind == "func":
        return f"{_name(_part(e, 'fName'))}{{{_part(e, 'e')}}}"
    if kind == "fName":
        return _name(_all(e))
    if kind == "acc":
        return f"{ACCENTS.get(_value(props, 'chr') or '̂', r'\hat')}{{{_part(e, 'e')}}}"
    if kind == "bar":
        return f"\\{'underline' if _value(props, 'pos') == 'bot' else 'overline'}{{{_part(e, 'e')}}}"
    if kind == "groupChr":
        below = (_value(props, "pos") or "bot") == "bot"
        sign = ACCENTS.get(_value(props, "chr") or "⏟", r"\underbrace" if below else r"\overbrace")
        return f"{sign}{{{_part(e, 'e')}}}"
    if kind in ("limLow", "limUpp"):
        base, lim = _name(_part(e, "e")), _part(e, "lim").replace("\\rightarrow", "\\to")
        if base.strip("\\ ") in LIMITS and kind == "limLow":
            return f"{base}_{{{lim}}}"
        return f"\\{'underset' if kind == 'limLow' else 'overset'}{{{lim}}}{{{base}}}"
    if kind == "m":
        rows = [" & ".join(_all(c) for c in r.findall(M + "e")) for r in e.findall(M + "mr")]
        return "\\begin{matrix}" + " \\\\ ".join(rows) + "\\end{matrix}"
    if kind == "eqArr":
        rows = [_all(x) for x in e.findall(M + "e")]
        if len(rows) == 1:
            body, mark, tag = rows[0].partition("\\#")
            return f"{body.strip()}\\tag{{{tag.strip().strip('()')}}}" if mark else body
        return "\\begin{array}{c}" + " \\\\ ".join(rows) + "\\end{array}"
    if kind.endswith("Pr"):
        return ""
    return _all(e)


def _name(text: str) -> str:
    """A function's name as its command where there is one."""
    return "\\" + text.strip() + " " if text.strip() in FUNCTIONS else text
