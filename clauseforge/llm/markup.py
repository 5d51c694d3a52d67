"""Problem 6: markup residue in text, turned into clean text that keeps its structure.

A grammar of HTML, Markdown, wiki and LaTeX tokens finds the records that carry markup.  Over the pages of
one host (the chunks of one document that carry markup) all their tokens, markup and words, are grouped by
occurrence vector: tokens that occur equally often on the same pages form a class.  Classes with enough pages
and tokens that keep one order on a page are its template, nested where one lies in the gaps of another; what
stands between template tokens are the page's slots.  The text is then converted block by block.

Deduction alone cannot say which *record* has markup (most residue here stands in a single record of its
host, so it repeats nowhere); the grammar decides that, and the README says so.
"""

from __future__ import annotations

import bisect
import collections
import html
import html.entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from ._arrays import batches

# Element names of HTML and of wiki markup written like them.
TAGS = (
    "a abbr acronym article aside audio b base basefont bdi bdo big blink blockquote body br button canvas caption center cite code col "
    "colgroup dd del details dfn dir div dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head "
    "header hgroup hr html i iframe img input ins kbd label legend li link main map mark marquee math menu meta nav nobr noframes noscript "
    "nowiki object ol optgroup option p param pre q ref references s samp script section select small source span strike strong style "
    "sub summary sup svg table tbody td textarea tfoot th thead title tr tt u ul var video wbr gallery math poem syntaxhighlight includeonly noinclude"
).split()
# Element names that are English words a form's blank may hold; alone they need their closing tag.
WORDS_TOO = "article aside button canvas caption center cite code details figure footer form header input label legend link main map mark menu meta object option q section select small source span strong style sub summary title var video".split()


def _either(names: list[str]) -> str:
    return "|".join(sorted(set(names), key=lambda t: (-len(t), t)))


_ATTRIBUTES = r"(?:\s+(?:[a-zA-Z_:@][\w:.-]*\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'<>=]+)|nowrap|noshade|checked|disabled|selected|hidden|compact|readonly|required|multiple|async|defer))"
_TAG = rf"(?i:</?(?:{_either([t for t in TAGS if t not in WORDS_TOO])}){_ATTRIBUTES}*\s*/?>|<(?:{_either(WORDS_TOO)})(?:{_ATTRIBUTES}+\s*/?|\s*/)>|</(?:{_either(WORDS_TOO)})\s*>|<({_either(WORDS_TOO)})\s*>(?=[\s\S]*</\1\s*>))"
_ENTITY = r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|" + "|".join(sorted({n[:-1] for n in html.entities.html5 if n.endswith(";")}, key=lambda n: (-len(n), n))) + ");"

#: Kinds of markup tokens, tried in this order at each place.
GRAMMAR: list[tuple[str, str]] = [
    ("comment", r"<!--[\s\S]*?(?:-->|\Z)|<!DOCTYPE[^>]*>|<!\[CDATA\[|<\?xml[^>]*>"),
    ("tag", _TAG),
    ("entity", _ENTITY),
    ("fence", r"(?m:^[ \t]*(?:```+|~~~+)[^\n`]*$)"),
    ("heading", r"(?m:^[ \t]{0,3}\#{1,6}[ \t]+\S[^\n]*$)"),
    ("wiki_heading", r"(?m:^(={2,6})[ \t]*[^=\s][^\n]*?[ \t]*\1[ \t]*$)"),
    ("redirect", r"(?mi:^\#REDIRECT\b)"),
    ("wiki_table", r"(?m:^[ \t]*(?:\{\||\|\}|\|-+[ \t]*$))"),
    ("table", r"(?m:^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*$)"),
    ("quote", r"(?m:^[ \t]{0,3}>+[ \t]+(?=\S))"),
    ("task", r"(?m:^[ \t]*[-*+][ \t]+\[[ xX]\][ \t])"),
    ("note", r"\[\^[^\]\s]{1,40}\]:?"),
    ("image", r"!\[[^\]\n]*\]\([^()\s]*(?:[ \t]+\"[^\"\n]*\")?\)"),
    ("link", r"(?<!\!)\[[^\[\]\n]+\]\((?:[^()\s]|\([^()\s]*\))+(?:[ \t]+\"[^\"\n]*\")?\)"),
    ("link_target", r"(?m:^[ \t]{0,3}\[[^\]\n]+\]:[ \t]*(?:https?://|/|\#)\S*)"),
    ("autolink", r"<(?:https?|ftp|mailto):[^<>\s]+>"),
    ("wiki_link", r"\[\[[^\[\]\n]+\]\]"),
    ("wiki_url", r"\[(?:https?|ftp)://[^\s\]]+(?:[ \t][^\]\n]*)?\]"),
    ("template", r"\{\{[^{}]*\}\}"),
    ("wiki_emphasis", r"(?<!')'{2,5}(?!')(?=\S)[^\n]*?(?<=[^\s'])'{2,5}(?!')"),
    ("environment", r"\\(?:begin|end)\s*\{[^{}\n]*\}"),
    ("formula", r"\\\((?=\S|\s)[\s\S]*?\\\)|\\\[[\s\S]*?\\\]|\$\$[\s\S]+?\$\$|(?<![\w$\\])\$(?=[^\s$])[^$\n]*?(?<=[^\s$\\])\$(?![\w$])"),
    ("command", r"(?<![\w:\\/.])\\[a-zA-Z]{2,}\*?(?![a-zA-Z\\])|(?<![:\\])\\[%&\#_${}](?![a-zA-Z]*\\)"),
    ("code", r"(?<!`)(`+)(?!`)[^\n]*?(?<!`)\1(?!`)"),
    ("strike", r"~~(?=\S)[^~\n]+?(?<=\S)~~"),
    ("strong", r"\*\*(?=[^\s*])[^\n]*?(?<=[^\s*])\*\*(?!\*)|(?<!\w)__(?=[^\s_])[^\n]*?(?<=[^\s_])__(?!\w)"),
    ("emphasis", r"(?<![\w*)])\*(?=[^\s*])[^*\n]*?(?<=[^\s*(])\*(?![\w*])|(?<![\w_])_(?=[^\s_])[^_\n]*?(?<=[^\s_])_(?![\w_])"),
]


def _compile() -> re.Pattern:
    parts, groups = [], 0
    for name, pattern in GRAMMAR:
        own = re.compile(pattern).groups
        pattern = re.sub(r"\\([1-9])", lambda _, g=groups + 2: f"\\{g}", pattern)
        parts.append(f"(?P<{name}>{pattern})")
        groups += 1 + own
    # Only a few characters begin a token; white space does at the start of a line.
    return re.compile(r"(?=[<&`~#={|>*+\[!'\\$_:-]|(?m:^)[ \t])(?:" + "|".join(parts) + ")")


MARKUP = _compile()
#: Characters without one of which no token can be.
_HINT = re.compile(r"[<&#=|>\[{\\$`~*_']|---")
MIN_PAGES, MIN_TOKENS = 3, 3

BLOCKS = "array<struct<kind:string,level:int,text:string,template:boolean>>"

# ---------------------------------------------------------------- openers without a closer
# A pattern that looks ahead for its closer reads to the end of the line or text where there is none.  Many such
# openers would cost their number times the length, so they are masked beforehand: found in one walk over openers
# and closers, each replaced by a surrogate that begins no token and is put back afterwards.

#: Up to so many openers of a kind are left to the patterns.
FEW = 8
_MASKED = "'*_`\\<!["
_MASK = {ord(c): 0xD810 + i for i, c in enumerate(_MASKED)}
_UNMASK = {v: k for k, v in _MASK.items()}

#: Openers, closers and whether the closer must stand in the same line.
_PAIRED: list[tuple[str, re.Pattern, re.Pattern, bool]] = [
    ("''", re.compile(r"(?<!')'{2,5}(?!')(?=\S)"), re.compile(r"(?<=[^\s'])'{2,5}(?!')"), True),
    ("**", re.compile(r"\*\*(?=[^\s*])"), re.compile(r"(?<=[^\s*])\*\*(?!\*)"), True),
    ("__", re.compile(r"(?<!\w)__(?=[^\s_])"), re.compile(r"(?<=[^\s_])__(?!\w)"), True),
    ("![", re.compile(r"!\["), re.compile(r"\]\("), True),
    ("[http", re.compile(r"\[https?://"), re.compile(r"\]"), True),
    ("[ftp", re.compile(r"\[ftp://"), re.compile(r"\]"), True),
    ("\\(", re.compile(r"\\\("), re.compile(r"\\\)"), False),
    ("\\[", re.compile(r"\\\["), re.compile(r"\\\]"), False),
    ("<!DOCTYPE", re.compile(r"<!DOCTYPE"), re.compile(">"), False),
    ("<?xml", re.compile(r"<\?xml"), re.compile(">"), False),
]
_TICKS = re.compile(r"`+")
_FENCE = re.compile(r"[ \t]*+(?:```|~~~)")


def _dead(text: str, paired: list[tuple[str, re.Pattern, re.Pattern, bool]]) -> list[tuple[int, int]]:
    """Spans of openers that no closer follows, of kinds that occur often."""
    out: list[tuple[int, int]] = []
    for hint, opener, closer, in_line in paired:
        if text.count(hint) <= FEW:
            continue
        closers = [m.start() for m in closer.finditer(text)]
        done, c, line_end = 0, 0, -1
        for m in opener.finditer(text):
            if m.start() < done:
                continue
            while c < len(closers) and closers[c] < m.end():
                c += 1
            if in_line and line_end < m.end():
                line_end = text.find("\n", m.end())
                line_end = len(text) if line_end < 0 else line_end
            if c < len(closers) and (not in_line or closers[c] < line_end):
                done = closers[c] + 1
            elif not closer.match(text, m.start()):  # else it may close what another opener began
                out.append(m.span())
    if text.count("`") > FEW:
        at = 0
        for line in text.split("\n"):
            runs = [m.span() for m in _TICKS.finditer(line)]
            if runs and not _FENCE.match(line):
                sizes = collections.Counter(e - b for b, e in runs)
                out += [(at + b, at + e) for b, e in runs if sizes[e - b] == 1]  # no other run could close it
            at += len(line) + 1
    return out


def _dead_tags(text: str, names: list[str]) -> list[tuple[int, int]]:
    """The same for elements that only count with their closing tag."""
    if text.count("<") <= FEW:
        return []
    low = text.lower() if len(text.lower()) == len(text) else "".join(c.lower() if c.isascii() else c for c in text)
    out: list[tuple[int, int]] = []
    for name in names:
        if low.count("<" + name) <= FEW:
            continue
        closers = [m.start() for m in re.finditer(rf"</{name}\s*+>", low)]
        last = closers[-1] if closers else -1
        last_end = low.rfind(">")
        out += [(m.start(), m.start() + 1) for m in re.finditer(rf"<{name}(?![a-z0-9])", low) if m.start() >= min(last, last_end)]
    return out


def _masked(text: str, spans: list[tuple[int, int]]) -> str:
    if not spans:
        return text
    parts, at = [], 0
    for a, b in sorted(spans):
        if a < at:
            continue
        # The whole run of the character goes, so that what is left of it begins nothing new.
        while a > at and text[a - 1] == text[a] and text[a] in "'*_`":
            a -= 1
        while b < len(text) and text[b] == text[b - 1] and text[b] in "'*_`":
            b += 1
        parts += [text[at:a], text[a:b].translate(_MASK)]
        at = b
    return "".join([*parts, text[at:]])


def _ready(text: str) -> str:
    """The text as the grammar reads it: of the same length, without openers that lead nowhere."""
    return _masked(text, _dead(text, _PAIRED) + _dead_tags(text, WORDS_TOO))


def tokens(text: str) -> list[tuple[int, int, str]]:
    """Begin, end and kind of the markup tokens of a text."""
    return [(m.start(), m.end(), m.lastgroup) for m in MARKUP.finditer(_ready(text))] if _HINT.search(text) else []


def has_markup(text: str | None) -> bool:
    return bool(text) and _HINT.search(text) is not None and MARKUP.search(_ready(text)) is not None


# ---------------------------------------------------------------- conversion

_SKIPPED = re.compile(r"<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?(?:-->|\Z)|<!DOCTYPE[^>]*>|<\?xml[^>]*>", re.S | re.I)
_VERBATIM = re.compile(r"<(pre|nowiki|code|math|syntaxhighlight)\b[^>]*>(.*?)</\1\s*>|^[ \t]*(```+|~~~+)([^\n`]*)\n(.*?)(?:\n[ \t]*\3[ \t]*$|\Z)|(?<!`)(`+)(?!`)([^\n]*?)(?<!`)\6(?!`)|\\begin\{(equation\*?|align\*?|verbatim|displaymath)\}(.*?)\\end\{\8\}|\\\[(.*?)\\\]|\\\((.*?)\\\)|\$\$(.+?)\$\$|(?<![\w$\\])\$(?=[^\s$])([^$\n]*?)(?<=[^\s$\\])\$(?![\w$])", re.S | re.M | re.I)
_ANY_TAG = re.compile(rf"</?(?:{_either(TAGS)}){_ATTRIBUTES}*\s*/?>", re.I)
_TAG_NAME = re.compile(r"</?\s*([a-zA-Z0-9]+)")
# Marks of the conversion: lone surrogates, which no valid text holds.
_KEEP = "\ud801"  # opens a kept piece, with its number, closed by the next character
_SHUT = "\ud802"
_CELL = "\ud803"


class _Kept:
    def __init__(self) -> None:
        self.pieces: list[tuple[str, str]] = []

    def put(self, kind: str, text: str, block: bool) -> str:
        self.pieces.append((kind, text))
        mark = f"{_KEEP}{len(self.pieces) - 1}{_SHUT}"
        return f"\n{mark}\n" if block else mark

    def verbatim(self, m: re.Match) -> str:
        g = m.groups()
        if g[0]:
            name, body = g[0].lower(), html.unescape(_ANY_TAG.sub("", g[1]) if g[0].lower() != "nowiki" else g[1])
            if name == "math":
                return self.put("formula", body.strip(), False)
            return self.put("text", body, False) if name == "nowiki" else self.put("code", body.strip("\n"), name != "code")
        if g[2]:
            return self.put("code", g[4], True)
        if g[5]:
            return self.put("code", g[6].strip(), False)
        if g[7]:
            return self.put("code" if g[7] == "verbatim" else "formula", g[8].strip(), True)
        if g[9] is not None:
            return self.put("formula", g[9].strip(), True)
        if g[11] is not None:
            return self.put("formula", g[11].strip(), True)
        return self.put("formula", (g[10] if g[10] is not None else g[12]).strip(), False)


def _tag(m: re.Match) -> str:
    tag = m[0]
    name, closing = _TAG_NAME.match(tag)[1].lower(), tag[1] == "/"
    if re.fullmatch(r"h[1-6]", name):
        return "\n" if closing else "\n" + "#" * int(name[1]) + " "
    if name in ("td", "th"):
        return "" if closing else _CELL
    if name in ("li", "dt", "dd"):
        return "\n" if closing else "\n- "
    if name == "blockquote":
        return "\n" if closing else "\n> "
    if name in ("tr", "p", "div", "br", "table", "ul", "ol", "dl", "hr", "section", "article", "center", "caption", "title", "body", "html", "head", "form", "header", "footer", "nav", "tbody", "thead"):
        return "\n"
    return ""


_INLINE: list[tuple[re.Pattern, str]] = [
    (re.compile(r"!\[([^\]\n]*)\]\([^()\n]*\)"), r"\1"),
    (re.compile(r"\[([^\[\]\n]+)\]\((?:[^()\s]|\([^()\s]*\))+(?:[ \t]+\"[^\"\n]*\")?\)"), r"\1"),
    (re.compile(r"\[\[(?:File|Image):[^\[\]\n|]*(?:\|[^\[\]\n|]*)*?(?:\|([^\[\]\n|]*))?\]\]", re.I), r"\1"),
    (re.compile(r"\[\[Category:[^\[\]\n]*\]\]", re.I), ""),
    (re.compile(r"\[\[(?:[^\[\]\n|]*\|)?([^\[\]\n|]*)\]\]"), r"\1"),
    (re.compile(r"\[(?:https?|ftp)://[^\s\]]+[ \t]+([^\]\n]*)\]"), r"\1"),
    (re.compile(r"\[(?:https?|ftp)://[^\s\]]+\]"), ""),
    (re.compile(r"<((?:https?|ftp|mailto):[^<>\s]+)>"), r"\1"),
    (re.compile(r"\[\^[^\]\s]{1,40}\](?!:)"), ""),
    (re.compile(r"(?<!')'{2,5}(?!')(\S[^\n]*?)'{2,5}(?!')"), r"\1"),
    (re.compile(r"~~(?=\S)([^~\n]+?)(?<=\S)~~"), r"\1"),
    (re.compile(r"\*\*(?=[^\s*])([^\n]*?)(?<=[^\s*])\*\*(?!\*)"), r"\1"),
    (re.compile(r"(?<!\w)__(?=[^\s_])([^\n]*?)(?<=[^\s_])__(?!\w)"), r"\1"),
    (re.compile(r"(?<![\w*)])\*(?=[^\s*])([^*\n]*?)(?<=[^\s*(])\*(?![\w*])"), r"\1"),
    (re.compile(r"(?<![\w_])_(?=[^\s_])([^_\n]*?)(?<=[^\s_])_(?![\w_])"), r"\1"),
    (re.compile(r"\\(?:label|cite[a-z]*|ref|eqref|pageref|vspace|hspace|noindent|centering|includegraphics)\*?(?:\[[^\]\n]*\])?(?:\{[^{}\n]*\})?"), ""),
    (re.compile(r"\\footnote\{([^{}\n]*)\}"), r" (\1)"),
    (re.compile(r"(?<![\w:\\/.])\\[a-zA-Z]{2,}\*?(?:\[[^\]\n]*\])?\{([^{}\n]*)\}"), r"\1"),
    (re.compile(r"(?<![:\\])\\([%&#_${}])"), r"\1"),
    (re.compile(r"(?<=\S)~(?=\S)"), " "),
]
_SECTION = re.compile(r"\\(part|chapter|section|subsection|subsubsection|paragraph)\*?\{([^{}\n]*)\}")
_DEPTH = {"part": 1, "chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4}


def _template(body: str) -> str:
    """A wiki template becomes its name and values."""
    parts = [p.strip() for p in body.split("|")]
    return parts[0] + (": " + ", ".join(p.partition("=")[2].strip() if "=" in p else p for p in parts[1:]) if parts[1:] else "")


def _inline(line: str) -> str:
    masked = _masked(line, _dead(line, _PAIRED))
    for pattern, by in _INLINE:
        masked = pattern.sub(by, masked)
    return masked.translate(_UNMASK)


def _closed(heading: str) -> str:
    """A Markdown heading without the number signs that may close it."""
    plain = heading.rstrip("#")
    return plain.rstrip(" \t") if plain != heading and plain[-1:] in (" ", "\t") else heading


_VERBATIM_TAGS = ["pre", "nowiki", "code", "math", "syntaxhighlight", "script", "style"]
_ENVIRONMENTS = ["equation", "equation*", "align", "align*", "verbatim", "displaymath"]
_AMPERSANDS = re.compile(r"&(?:amp;|#0*38;|#[xX]0*26;)+", re.I)


def _verbatim_ready(text: str) -> str:
    spans = _dead(text, _PAIRED) + _dead_tags(text, _VERBATIM_TAGS)
    if text.count("\\begin{") > FEW:
        for name in _ENVIRONMENTS:
            last = text.rfind(f"\\end{{{name}}}")
            spans += [(m.start(), m.start() + 1) for m in re.finditer(re.escape(f"\\begin{{{name}}}"), text) if m.start() > last]
    return _masked(text, spans)


def _templates(text: str) -> str:
    """Wiki templates, from the inner to the outer, in one walk."""
    if "{{" not in text:
        return text
    stack: list[list[str]] = [[]]
    for piece in re.split(r"(\{\{|\}\})", text):
        if piece == "{{":
            stack.append([])
        elif piece == "}}" and len(stack) > 1:
            body = "".join(stack.pop())
            stack[-1].append(_template(body) if "{" not in body and "}" not in body else "{{" + body + "}}")
        else:
            stack[-1].append(piece)
    return "{{".join("".join(parts) for parts in stack)  # those above the first were never closed


def convert(text: str) -> list[tuple[str, int, str]]:
    """Blocks ``(kind, level, text)``; kinds: heading, item, row, code, formula, quote, text."""
    kept = _Kept()
    text = text.replace("\r\n", "\n")
    before = None
    while text != before:  # escaped tags show after a round
        before = text
        text = _VERBATIM.sub(kept.verbatim, _SKIPPED.sub("", _verbatim_ready(text))).translate(_UNMASK)
        text = _ANY_TAG.sub(_tag, text)
        text = html.unescape(_AMPERSANDS.sub("&", text))  # however often it was escaped
    text = _templates(text)
    text = _SECTION.sub(lambda m: f"\n{'#' * _DEPTH[m[1]]} {m[2]}\n", text)
    tabular = "\\begin{tabular}" in text
    text = re.sub(r"\\(?:begin|end)\s*\{tabular\}(?:\{[^{}]*\})?", "\n", text)
    text = re.sub(r"\\(?:begin|end)\s*\{[^{}\n]*\}(?:\[[^\]\n]*\])?", "\n", text)
    if tabular:
        text = re.sub(r"\\\\[ \t]*", "\n", text)
    text = re.sub(r"\\item\b[ \t]*", "\n- ", text)
    blocks: list[tuple[str, int, str]] = []
    wiki = markdown_table = False
    lines = text.split("\n")
    for n, line in enumerate(lines):
        s = line.strip()
        if not s:
            markdown_table = False
            continue
        if m := re.fullmatch(rf"{_KEEP}(\d+){_SHUT}", s):
            kind, body = kept.pieces[int(m[1])]
            blocks.append((kind, 0, body))
        elif s.startswith("{|"):
            wiki = True
        elif wiki and s.startswith("|}"):
            wiki = False
        elif wiki and re.match(r"\|-+$", s):
            continue
        elif wiki and s[0] in "|!":
            cells = re.split(r"\|\||!!", s[1:])
            blocks.append(("row", 0, " | ".join(_inline(c).strip() for c in cells)))
        elif _CELL in s:
            blocks.append(("row", 0, " | ".join(_inline(c).strip() for c in s.split(_CELL) if c.strip())))
        elif re.fullmatch(r"\|?[ \t]*+:?-{3,}+:?[ \t]*+(?:\|[ \t]*+:?-{3,}+:?[ \t]*+)++\|?", s):
            markdown_table = True
        elif s.count("|") >= 2 and s[0] == "|" and (markdown_table or n + 1 < len(lines) and re.match(r"\s*+\|?[ \t]*+:?-{3,}", lines[n + 1])):
            blocks.append(("row", 0, " | ".join(_inline(c).strip() for c in s.strip("|").split("|"))))
        elif tabular and " & " in s:
            blocks.append(("row", 0, " | ".join(_inline(c).strip() for c in s.split(" & "))))
        elif m := re.fullmatch(r"(#{1,6})[ \t]+(.*)", s):
            blocks.append(("heading", len(m[1]), _inline(_closed(m[2])).strip()))
        elif m := re.fullmatch(r"(={2,6})[ \t]*+(.*)\1", s):
            blocks.append(("heading", len(m[1]), _inline(m[2]).strip()))
        elif m := re.fullmatch(r"#REDIRECT\b[ \t]*(.*)", s):
            blocks.append(("text", 0, _inline(m[1]).strip()))
        elif m := re.fullmatch(r">+[ \t]*(.*)", s):
            blocks.append(("quote", 0, _inline(m[1]).strip()))
        elif m := re.fullmatch(r"\[\^([^\]\s]{1,40})\]:[ \t]*(.*)", s):
            blocks.append(("text", 0, _inline(m[2]).strip()))
        elif m := re.fullmatch(r"(?:[-*+]|\*{2,}|#{1,3})[ \t]+(?:\[[ xX]\][ \t]+)?(.*)", s):
            blocks.append(("item", (len(line) - len(line.lstrip())) // 2, _inline(m[1]).strip()))
        else:
            blocks.append(("text", 0, _inline(line).strip()))

    def back(t: str, below: int) -> str:  # a piece holds earlier ones only
        return re.sub(rf"{_KEEP}(\d+){_SHUT}", lambda m: back(kept.pieces[n][1], n) if (n := int(m[1])) < below else m[0], t)

    return [(k, v, back(t, len(kept.pieces))) for k, v, t in blocks if t]


# ---------------------------------------------------------------- template deduction

_WORDS = re.compile(r"\w+", re.U)
#: Kinds whose tokens hold the words they mark up.
_HOLDS = {"heading", "wiki_heading", "note", "image", "link", "autolink", "wiki_link", "wiki_url", "template", "wiki_emphasis", "formula", "code", "strike", "strong", "emphasis"}
#: Kinds whose tokens may hold further tokens, and where in them.
_INSIDE = {
    "heading": r"[ \t]*#+[ \t]+(?P<in>.*)", "wiki_heading": r"(=+)(?P<in>.*)\1[ \t]*", "link": r"\[(?P<in>[^\]]*)\].*", "wiki_link": r"\[\[(?P<in>.*)\]\]", "template": r"\{\{(?P<in>.*)\}\}",
    "wiki_emphasis": r"'+(?P<in>.*?)'+", "strike": r"~~(?P<in>.*)~~", "strong": r"(\*\*|__)(?P<in>.*)\1", "emphasis": r"([*_])(?P<in>.*)\1",
}
_INSIDE = {kind: re.compile(pattern, re.S) for kind, pattern in _INSIDE.items()}


def _words(text: str, begin: int, end: int) -> list[tuple[str, int, int]]:
    return [("w:" + m[0], m.start(), m.end()) for m in _WORDS.finditer(text, begin, end)]


def _held(text: str, a: int, b: int, kind: str) -> list[tuple[str, int, int]]:
    """Words and further tokens within a token, in order."""
    if kind not in _INSIDE:
        return _words(text, a, b)
    begin, end = _INSIDE[kind].fullmatch(text, a, b).span("in")
    out: list[tuple[str, int, int]] = []
    at = begin
    if _HINT.search(text, begin, end):
        # With the character before, after which no line begins.
        for m in MARKUP.finditer(_ready(text[begin - 1 : end]), 1):
            c, d = m.start() + begin - 1, m.end() + begin - 1
            out += _words(text, at, c) + _token(text, c, d, m.lastgroup)
            at = d
    return out + _words(text, at, end) + (_words(text, end, b) if kind == "link" else [])


def _token(text: str, a: int, b: int, kind: str) -> list[tuple[str, int, int]]:
    """A markup token; one that holds words becomes its begin, what it holds, which varies from page to page, and its end."""
    name = re.sub(r"=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", "=", text[a:b]) if kind == "tag" else kind
    inner = _held(text, a, b, kind) if kind in _HOLDS else []
    return [(f"m:{name}", a, inner[0][1]), *inner, (f"m:/{name}", inner[-1][2], b)] if inner else [(f"m:{name}", a, b)]


def page_tokens(text: str) -> list[tuple[str, int, int]]:
    """Tokens of the marked-up lines in order, with their place: markup tokens (tags without attributes' values) and words."""
    found = tokens(text)
    out: list[tuple[str, int, int]] = []
    at = 0
    for n, (a, b, kind) in enumerate(found):
        begin = max(at, text.rfind("\n", 0, a) + 1)
        out += _words(text, begin, a) + _token(text, a, b, kind)
        at = b
        end = text.find("\n", b)
        end = len(text) if end < 0 else end
        if text[b - 1] != "\n" and (n + 1 == len(found) or found[n + 1][0] > end):  # the last token of its line
            out += _words(text, b, end)
            at = end
    return out


def whole_page(text: str) -> list[tuple[str, int, int]]:
    """All tokens of a page in order: those of its marked-up lines and the words of all other lines."""
    out: list[tuple[str, int, int]] = []
    at = 0
    for token in page_tokens(text):
        out += [*_words(text, at, token[1]), token]
        at = token[2]
    return out + _words(text, at, len(text))


def slots(text: str, page: list[tuple[str, int, int]], classes: dict[int, set[str]]) -> tuple[list[str], int, set[str]]:
    """What stands before, between and after template tokens on a page, how many of the host's classes are valid on it,
    and the words that are template tokens.

    A class is valid where its tokens come round in one order; of two classes that cross (neither lies
    within the gaps of the other) the one that begins later is left out.
    """
    kept: list[tuple[list[tuple[int, int]], int]] = []  # a class's tokens on the page, and how many make a round
    words: set[str] = set()
    for names in sorted(classes.values(), key=lambda c: next((i for i, t in enumerate(page) if t[0] in c), 0)):
        places = [(t, a, b) for t, a, b in page if t in names]
        first = list(dict.fromkeys(t for t, _, _ in places))
        rounds, rest = divmod(len(places), max(1, len(first)))
        if rest or [t for t, _, _ in places] != first * rounds:
            continue
        this = ([(a, b) for _, a, b in places], len(first))
        if all(_within(this, other) or _within(other, this) for other in kept):
            kept.append(this)
            words |= {t[2:] for t in names if t.startswith("w:")}
    marks = sorted(x for spans, _ in kept for x in spans)
    ends = [(0, 0), *marks, (len(text), len(text))] if marks else []
    found = [re.sub(r"\s+", " ", text[b:c]).strip() for (_, b), (c, _) in zip(ends, ends[1:]) if b < c]
    return [s for s in found if s], len(kept), words


def _of_template(text: str, words: set[str]) -> bool:
    """Whether a block has words and all of them belong to the template."""
    found = _WORDS.findall(text)
    return bool(found) and words.issuperset(found)


def _within(inner: tuple[list[tuple[int, int]], int], outer: tuple[list[tuple[int, int]], int]) -> bool:
    """Whether each round of the inner class lies in a single gap of the outer one."""
    spans, width = inner
    begins = [a for a, _ in outer[0]]
    gaps = [bisect.bisect(begins, a) for a, _ in spans]
    return all(len(set(gaps[k : k + width])) == 1 for k in range(0, len(gaps), width))


def marked_records(df: DataFrame, id: str, text: str, host: str, order: str) -> DataFrame:
    """``id, host, text`` of the records whose text has markup tokens, one row per id and text."""
    kind = df.schema[id].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, "text"):
            keep = [has_markup(t) for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    rows = df.select(df[id].alias("id"), df[host].cast("string").alias("host"), df[text].alias("text"), df[order].alias("o")).filter(F.col("text").rlike(r"[<&#=|>\[{\\$`~*_']"))
    marked = rows.mapInArrow(run, f"id {kind}, host string, text string, o {df.schema[order].dataType.simpleString()}")
    return marked.groupBy("id").agg(F.max(F.struct("o", "text", "host")).alias("r")).select("id", "r.host", "r.text")


def page_occurrences(marked: DataFrame) -> DataFrame:
    """``host, page, token, n``: how often each token stands on each page of a host."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, "text"):
            host, page, token, count = [], [], [], []
            for h, k, t in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "text"))):
                seen: dict[str, int] = {}
                for name, _, _ in whole_page(t):
                    seen[name] = seen.get(name, 0) + 1
                host += [h] * len(seen)
                page += [k] * len(seen)
                token += list(seen)
                count += list(seen.values())
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(page, pa.int64()), pa.array(token, pa.string()), pa.array(count, pa.int64())], ["host", "page", "token", "n"])

    pages = marked.select("host", F.xxhash64("id").alias("page"), "text").filter("host IS NOT NULL")
    return pages.mapInArrow(run, "host string, page long, token string, n long")


def template_tokens(occurrences: DataFrame, min_pages: int = MIN_PAGES, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``host, token, vector, pages``: the tokens of each host that belong to an equivalence class.

    Vectors are compared by an exclusive-or of hashes of (page, count), so no page list is ever held
    together; counts, vectors and class sizes are partial aggregates.
    """
    vectors = occurrences.groupBy("host", "token").agg(F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count("*").alias("pages")).filter(F.col("pages") >= min_pages)
    classes = (
        vectors.groupBy("host", "vector", "pages")
        .agg(F.count("*").alias("tokens"), F.max(F.col("token").startswith("m:").cast("int")).alias("marked"))
        .filter((F.col("tokens") >= min_tokens) & (F.col("marked") == 1))
    )
    return vectors.join(classes, ["host", "vector", "pages"]).select("host", "token", "vector", "pages")


def page_classes(marked: DataFrame) -> DataFrame:
    """``page, classes``: for each page its tokens that belong to a class of the host, with the class.

    The classes' tokens are counted and broadcast if they are few; else they are joined by host *and* token, where
    adaptive execution splits a token that stands on all pages of a large host.  What is collected per page is
    bounded by the page.
    """
    occurrences = checkpoint(page_occurrences(marked))  # counted for the vectors, then read again
    valid = checkpoint(template_tokens(occurrences).drop("pages"))
    if valid.count() <= 500_000:
        valid = F.broadcast(valid)
    return occurrences.join(valid, ["host", "token"]).groupBy("page").agg(F.collect_list(F.struct("vector", "token")).alias("classes"))


def host_templates(df: DataFrame, id: str = "id", text: str = "content", host: str = "doc_id", order: str = "loaded_at") -> DataFrame:
    """``host, class_id, pages, tokens``: the deduced template of each host, one row per equivalence class.

    ``tokens`` (sorted) are markup tokens (``m:``) and words (``w:``) that occur equally often on the same ``pages``.
    """
    valid = template_tokens(page_occurrences(checkpoint(marked_records(df, id, text, host, order))))
    return valid.groupBy("host", F.col("vector").alias("class_id")).agg(F.max("pages").alias("pages"), F.array_sort(F.collect_list("token")).alias("tokens"))


def clean_records(df: DataFrame, id: str = "id", text: str = "content", host: str = "doc_id", order: str = "loaded_at") -> DataFrame:
    """``id, blocks, text, template_classes, slots`` of each record with markup.

    ``blocks`` are the converted text in order with their kinds (heading, item, row, code, formula,
    quote, text) and whether they are made of the host's template alone; ``text`` has the texts of the other
    blocks line by line.  Records without markup, null and empty texts
    are not in the result (their text is clean as it is); of several rows of one id the latest by
    ``order`` that has markup counts.  A null host is the host of no template.
    """
    kind = df.schema[id].dataType.simpleString()
    marked = checkpoint(marked_records(df, id, text, host, order))  # only records with markup
    joined = marked.withColumn("page", F.xxhash64("id")).join(page_classes(marked), "page", "left").select("id", "text", "classes")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.list_(pa.struct([("kind", pa.string()), ("level", pa.int32()), ("text", pa.string()), ("template", pa.bool_())]))
        for batch in batches(it, "text"):
            blocks, plain, valid, slot = [], [], [], []
            for t, pairs in zip(batch.column("text").to_pylist(), batch.column("classes").to_pylist()):
                classes: dict[int, set[str]] = {}
                for p in pairs or ():
                    classes.setdefault(p["vector"], set()).add(p["token"])
                found, n, words = slots(t, whole_page(t), classes) if classes else ([], 0, set())
                parts = [{"kind": k, "level": v, "text": x, "template": bool(words) and _of_template(x, words)} for k, v, x in convert(t)]
                blocks.append(parts)
                plain.append("\n".join(b["text"] for b in parts if not b["template"]))
                valid.append(n)
                slot.append(found)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(blocks, block), pa.array(plain, pa.string()), pa.array(valid, pa.int32()), pa.array(slot, pa.list_(pa.string()))], ["id", "blocks", "text", "template_classes", "slots"])

    out = joined.mapInArrow(run, f"id {kind}, blocks {BLOCKS}, text string, template_classes int, slots array<string>")
    return out.withColumnRenamed("id", id)
