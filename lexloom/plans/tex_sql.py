"""TeX cleaning in SQL, with its tables written out a second time so that a wrong entry shows on one side only.

RE2 has no look-behind; `\\w` and `\\s` are spelled out, as they are ASCII there.
"""

from __future__ import annotations

# Fixed value: white space as Python sees it.
BLANK = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# Commands and the signs they stand for, in order.
SIGNS = (
    r"\alpha α \beta β \gamma γ \delta δ \epsilon ε \zeta ζ \eta η \theta θ \iota ι \kappa κ \lambda λ \mu μ \nu ν \xi ξ \pi π \rho ρ \sigma σ \tau τ "
    r"\upsilon υ \phi φ \chi χ \psi ψ \omega ω \Gamma Γ \Delta Δ \Theta Θ \Lambda Λ \Xi Ξ \Pi Π \Sigma Σ \Phi Φ \Psi Ψ \Omega Ω "
    r"\varepsilon ε \varphi φ \varrho ρ \vartheta θ \varsigma ς \infty ∞ \nabla ∇ \partial ∂ \int ∫ \sum ∑ \prod ∏ \approx ≈ \neq ≠ \leq ≤ \geq ≥ "
    r"\pm ± \times × \cdot · \sim ~ \rightarrow → \leftarrow ← \Rightarrow ⇒ \Leftarrow ⇐ \leftrightarrow ↔ \sqrt √ \forall ∀ \exists ∃ \in ∈ \subset ⊂ "
    r"\cup ∪ \cap ∩ \star ★ \circ ∘ \bullet • \langle ⟨ \rangle ⟩ \hbar ℏ \ell ℓ \prime ′ \cos cos \sin sin \tan tan \log log \exp exp \ln ln \max max "
    r"\min min \lim lim \AA Å \deg °"
).split()
# Environments of displayed formulas and commands of format, in order.
DISPLAYS = ("equation", r"equation\*", "align", r"align\*", "eqnarray", r"eqnarray\*", "gather", r"gather\*", "multline", r"multline\*", "displaymath")
FORMATS = (
    "textbf", "textit", "textrm", "texttt", "textsf", "textsc", "emph", "underline", "textup", "mbox", "mathrm", "mathbf", "mathit", "mathcal", "boldsymbol",
    "overline", "underline", "tilde", "hat", "bar", "vec", "widetilde", "widehat", "overrightarrow",
)
BODY = ((r"(?s)^.*?\\begin\{document\}", ""), (r"(?s)\\end\{document\}.*", ""))
COMMENTS = ((r"(^|[^\\])%[^\n]*", r"\1"),)
EQUATIONS = (*((rf"(?s)\\begin\{{{e}\}}.*?\\end\{{{e}\}}", "[EQUATION]") for e in DISPLAYS), (r"(?s)\\\[.*?\\\]", "[EQUATION]"), (r"(?s)\$\$.*?\$\$", "[EQUATION]"))
FORMATTED = tuple((rf"\\{c}\{{([^}}]*)\}}", r"\1") for c in FORMATS)
REFERENCES = ((r"\\(?:cite|citep|citet|citealt|citeauthor|citenum)\*?\{[^}]*\}", ""), (r"\\(?:ref|eqref|pageref|label|autoref|cref|Cref|nameref)\{[^}]*\}", ""))
BETWEEN = (
    (r"\^\{([^}]*)\}", r"\1"), (r"_\{([^}]*)\}", r"\1"), (r"\^([\p{L}\p{N}_])", r"\1"), (r"_([\p{L}\p{N}_])", r"\1"), (r"\\frac\{([^}]*)\}\{([^}]*)\}", r"\1/\2"),
    (r"\\(?:sub)*section\*?\{([^}]*)\}", "\n\n\\1\n\n"), (r"\\paragraph\*?\{([^}]*)\}", "\n\\1\n"),
)
AFTER = (
    (r"\\footnote\{([^}]*)\}", r" (\1)"), (r"\\begin\{(?:itemize|enumerate|description)\}", ""), (r"\\end\{(?:itemize|enumerate|description)\}", ""),
    (rf"\\item{BLANK}*(?:\[[^\]]*\])?{BLANK}*", "\n- "), (r"\\begin\{[^}]*\}", ""), (r"\\end\{[^}]*\}", ""),
    (r"\\(?:newline|linebreak|pagebreak|newpage|clearpage|noindent|maketitle)\b", ""), (r"\\(?:small|large|Large|LARGE|huge|Huge|tiny|normalsize|footnotesize|scriptsize)\b", ""),
    (r"\\(?:vspace|hspace)\*?\{[^}]*\}", ""), (r"\\(?:centering|raggedright|raggedleft)\b", ""), (r"\\(?:def|newcommand|renewcommand|DeclareMathOperator)\b[^\n]*", ""),
    (r"\{\}", ""), (r"\\[a-zA-Z]+\b", ""), ("~", " "), (r"\\&", "&"), (r"\\%", "%"), (r"\\\$", "$"), (r"\\#", "#"), (r"\\_", "_"), (r"\\\\", "\n"), ("``", '"'), ("''", '"'),
    (r"[{}]", ""), (r"[ \t]+", " "), (r"\n{3,}", "\n\n"),
)


def text(value: str) -> str:
    """A string as an SQL expression."""
    return "'" + value.replace("'", "''") + "'"


def sub(c: str, pattern: str, to: str, flags: str = "g") -> str:
    return f"regexp_replace({c}, {text(pattern)}, {text(to)}, '{flags}')"


def subs(c: str, *passes: tuple[str, str]) -> str:
    for pattern, to in passes:
        c = sub(c, pattern, to)
    return c


def strip(c: str) -> str:
    return sub(sub(c, rf"^{BLANK}+", "", ""), rf"{BLANK}+$", "", "")


def body(c: str) -> str:
    for pattern, to in BODY:
        c = sub(c, pattern, to, "")
    return c


def symbols(c: str) -> str:
    for name, sign in zip(SIGNS[::2], SIGNS[1::2]):
        c = f"replace({c}, '{name}', '{sign}')"
    return c


def cleaned(source: str, c: str, keep: str) -> str:
    """(keep, t): the rows of a query with their column c cleaned; tables are taken apart, as what stands for one depends on its caption."""
    table = text(r"(?s)\\begin\{table\*?\}.*?\\end\{table\*?\}")
    first = sub(subs(body(c), *COMMENTS), r"(?s)\\begin\{figure\*?\}.*?\\end\{figure\*?\}", "")
    mark = rf"CASE WHEN regexp_matches(x[i], '\\caption\{{[^}}]*\}}') THEN '[TABLE: ' || regexp_extract(x[i], '\\caption\{{([^}}]*)\}}', 1) || ']' ELSE '' END"
    joined = f"array_to_string(list_transform(range(1, len(s) + 1), lambda i: s[i] || CASE WHEN i > len(x) THEN '' ELSE {mark} END), '')"
    middle = subs(symbols(subs("u", *EQUATIONS, (r"\$([^$]+?)\$", r"\1"))), *BETWEEN, *FORMATTED, (r"\\(?:bf|it|rm|tt|sf|sc|sl|em)\b", ""), *REFERENCES, *AFTER)
    return f"""
        SELECT {keep}, {strip(middle)} AS t FROM (SELECT {keep}, {joined} AS u FROM
            (SELECT {keep}, string_split_regex(v, {table}) AS s, regexp_extract_all(v, {table}) AS x FROM (SELECT {keep}, {first} AS v FROM ({source}))))
    """
