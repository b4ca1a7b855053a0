"""Problem 5: broken pairs of question and answer.

Each defect has its own detector: a refusal grammar, greedy string tiling for
echoes, a pushdown parser for answers that break off, and script, function-word
and code-signature checks for the wrong language.  The first that applies, in
the order of ``DEFECTS``, names the defect.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import LANGUAGE_SPELLINGS, latest_copy

DEFECTS = ("empty", "refusal", "echo", "truncated", "wrong_language")

_FENCED = re.compile(r"(?ms)^[ \t>]*(`{3,}|~{3,})[ \t]*([\w+#.-]*)[^\n]*\n(.*?)(?:^[ \t>]*\1[ \t]*$|\Z)")
_INLINE = re.compile(r"`[^`\n]*`")
_WORD = re.compile(r"\w+")
_LETTERS = re.compile(r"[^\W\d_]+")


def prose(text: str) -> str:
    """The text without code blocks and inline code."""
    return _INLINE.sub(" ", _FENCED.sub("\n", text)) if "`" in text or "~~~" in text else text


# --- empty -----------------------------------------------------------------

_SHELL = re.compile(r"(?is)<!--.*?-->|</?[a-z][\w-]*(?:\s[^<>]*)?/?>")
_LABEL = re.compile(r"(?i)^\W*(?:(?:the )?(?:answer|solution|response|result|output|reply|code|explanation)|antwort|lösung|réponse|solución|respuesta|n/?a|tbd|todo)\W*$")
_LITERAL = re.compile(r"^\s*(?:\[\]|\{\}|\(\)|\"\"|''|[-+]?\d[\d.,]*%?|<[-\w.]+>)\s*$")


def is_empty(answer: str | None) -> bool:
    """No content: blanks, invisible characters, bare punctuation, empty fences or markup, or a heading alone."""
    if answer is None:
        return True
    if not _WORD.search(answer) and all(unicodedata.category(c) in ("Cf", "Cc", "Zs", "Zl", "Zp") for c in answer):
        return True
    if _LITERAL.match(answer) and not _SHELL.fullmatch(answer.strip()):
        return False
    body = re.sub(r"(?m)^[ \t]*(?:`{3,}|~{3,})[\w+#.-]*[ \t]*$", " ", answer)
    body = _SHELL.sub(" ", body) if _SHELL.search(body) and not re.search(r"\w", _SHELL.sub(" ", body)) else body
    if not re.search(r"\w", body):
        return _LITERAL.match(body.strip() or " ") is None
    return _LABEL.match(body.strip()) is not None


# --- refusal ---------------------------------------------------------------

# The words of each category of the refusal grammar (English, German, French, Spanish).
_CATEGORIES = {
    "s": "i we ich wir je j nous yo",  # who speaks
    "n": "not no never t nt cannot nicht kein keine ne n pas",  # negation; t as in can't
    "a": "can could able unable allowed permitted willing comfortable kann können darf dürfen möchte werde lage peux puis pouvons pourrai saurais suis autorisé puedo podemos podré posible",  # ability or leave
    "p": "permitted allowed possible erlaubt gestattet möglich permis permise possible permitido permitida posible",  # leave, said of the act
    "m": "must have has need needs will would going muss müssen dois devons vois préfère debo debemos tengo veo",  # force
    "d": "decline refuse pass turn declined refused ablehnen passen verweigern refuser décliner passer rechazar declinar negarme",  # declining
    "h": "help assist answer comply complete write do provide produce producing fulfil fulfill share support continue respond discuss generate create give given offer offered engage take work carry handle proceed go be this that on to with "
    "helfen antworten schreiben liefern beantworten unterstützen dabei weiterhelfen aider répondre fournir écrire faire cela ayudar responder escribir dar hacer eso",  # what is declined
    "r": "request question task answer response solution code reply this anfrage frage bitte demande question solicitud petición pregunta",  # what was asked for
    "x": "outside beyond außerhalb außerstande hors impossible fuera",  # out of reach
    "b": "scope remit guidelines capabilities",  # the limits
    "v": "won wont don do did could will would am",  # carries a negation
}
_CLASSES: dict[str, str] = {}
for _class, _words in _CATEGORIES.items():
    for _word in _words.split():
        _CLASSES[_word] = _CLASSES.get(_word, "") + _class
_IS = lambda c: rf"(?:\w*{c}\w*,)"  # noqa: E731  a word of class c, among its classes
_ANY = r"(?:\w*,)"
#: Sentences of the grammar over the categories of their words.
_PRODUCTIONS = [
    rf"{_IS('s')}{_ANY}{{0,4}}{_IS('a')}{_IS('n')}{_ANY}{{0,5}}{_IS('h')}",  # I can't help
    rf"{_IS('s')}{_ANY}{{0,3}}{_IS('n')}{_ANY}{{0,1}}{_IS('a')}",  # I am not able
    rf"{_IS('s')}{_ANY}{{0,4}}{_IS('n')}{_ANY}{{0,3}}{_IS('h')}",  # I cannot answer, I won't be producing
    rf"{_IS('s')}{_ANY}{{0,2}}{_IS('m')}{_ANY}{{0,4}}{_IS('d')}",  # I must respectfully decline
    rf"{_IS('s')}{_ANY}{{0,1}}{_IS('d')}",  # I decline
    rf"{_IS('r')}{_ANY}{{0,4}}{_IS('m')}{_ANY}{{0,3}}{_IS('d')}",  # this request has to be declined
    rf"{_IS('n')}{_ANY}{{0,1}}{_IS('r')}{_IS('a')}{_ANY}{{0,2}}{_IS('h')}",  # no answer can be given
    rf"{_IS('x')}{_ANY}{{0,3}}(?:{_IS('s')}{_ANY}{{0,3}}{_IS('a')}|{_ANY}{{0,2}}{_IS('b')})",  # outside of what I'm allowed, of my scope
    rf"(?:{_IS('a')}{_IS('s')}|{_IS('s')}{_IS('a')}){_ANY}{{0,6}}{_IS('n')}",  # kann ich ... nicht
    rf"{_IS('m')}{_IS('s')}{_ANY}{{0,5}}{_IS('d')}",  # muss ich ablehnen
    rf"{_IS('s')}{_IS('n')}{_IS('a')}",  # je ne peux
    rf"{_IS('n')}{_ANY}{{0,1}}{_IS('a')}{_ANY}{{0,3}}{_IS('h')}",  # no puedo ayudar
    rf"{_IS('n')}{_ANY}{{0,3}}{_IS('p')}{_ANY}{{0,3}}{_IS('h')}",  # no me está permitido responder
    rf"{_IS('m')}{_ANY}{{0,2}}{_IS('d')}(?={_ANY}{{0,4}}(?:{_IS('r')}|$))",  # debo rechazar
    rf"{_IS('x')}{_ANY}{{0,3}}$|m,{_IS('x')}",  # il m'est impossible
]
_GRAMMAR = re.compile("|".join(_PRODUCTIONS))
_UNABLE = re.compile(r"(?i)\b(?:i|we)(?:['’]m| am| are)? (?:\w+ )?unable\b|\bil m['’]est impossible\b|\b(?:ich|wir) (?:\w+ ){0,4}außerstande\b")
#: What a helpful answer says after such words: "I can't reproduce it, but the cause is clear".
_GOES_ON = re.compile(r"(?i)\b(?:reproduc|see|find|confirm|tell|repeat)\w*\b.{0,80}\bbut\b|, but (?:the|here|you|it)\b")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def declines(sentence: str) -> bool:
    """Is the sentence one of the refusal grammar: who speaks, negated ability or a decline, and the act?"""
    words = re.findall(r"[^\W\d_]+", sentence.lower())
    if not any("n" in _CLASSES.get(w, "") or "d" in _CLASSES.get(w, "") or "x" in _CLASSES.get(w, "") for w in words) and not _UNABLE.search(sentence):
        return False
    return _GRAMMAR.search("".join(_CLASSES.get(w, "") + "," for w in words)) is not None or _UNABLE.search(sentence) is not None


def _asked_words(text: str) -> set[str]:
    return {w for w in _LETTERS.findall(text.lower()) if len(w) > 3}


def is_refusal(answer: str, question: str = "") -> bool:
    """An answer that declines: a sentence of the refusal grammar, and no work beside it.

    Work is code, a diff, or as many sentences about what was asked (three of
    its words each) as not; the length of the answer does not matter.
    """
    if "```" in answer or answer.lstrip().startswith(("--- ", "diff ")):
        return False
    sentences = [x for x in _SENTENCE.split(answer.strip()) if x]
    at = next((i for i, x in enumerate(sentences) if "`" not in x and declines(x) and not _GOES_ON.search(x)), None)
    if at is None:
        return False
    rest = sentences[:at] + sentences[at + 1 :]
    if any("`" in x for x in rest):
        return False
    asked = _asked_words(question)
    return 2 * sum(len(_asked_words(x) & asked) >= 3 for x in rest) <= len(rest)


# --- echo ------------------------------------------------------------------


def tiled(a: list[str], b: list[str], least: int = 3) -> int:
    """Words of ``a`` covered by greedy string tiling with ``b``: longest common stretches first, none used twice."""
    used_a, used_b, covered = bytearray(len(a)), bytearray(len(b)), 0
    while True:
        at: dict[tuple, list[int]] = {}
        for j in range(len(b) - least + 1):
            if not any(used_b[j : j + least]):
                at.setdefault(tuple(b[j : j + least]), []).append(j)
        longest, tiles = least - 1, []
        i = 0
        while i <= len(a) - least:
            if any(used_a[i : i + least]):
                i += 1
                continue
            for j in at.get(tuple(a[i : i + least]), ()):
                k = least
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and not used_a[i + k] and not used_b[j + k]:
                    k += 1
                if k > longest:
                    longest, tiles = k, [(i, j, k)]
                elif k == longest and k >= least:
                    tiles.append((i, j, k))
            i += 1
        if not tiles:
            return covered
        for i, j, k in tiles:
            if not any(used_a[i : i + k]) and not any(used_b[j : j + k]):
                used_a[i : i + k] = used_b[j : j + k] = b"\x01" * k
                covered += k


def is_echo(question: str, answer: str) -> bool:
    """The answer is the question, at most lightly changed, and nothing more."""
    if not 0.7 * len(question) <= len(answer) <= 1.4 * len(question) + 60:
        return False
    q, a = _WORD.findall(question.casefold()), _WORD.findall(answer.casefold())
    if len(q) < 3 or not 0.75 * len(q) <= len(a) <= 1.3 * len(q) + 6:
        return False
    common = sum((Counter(q) & Counter(a)).values())
    if common < 0.8 * max(len(q), len(a) - 6):
        return False
    cover = tiled(a, q)
    return cover >= 0.75 * len(a) - 4 and cover >= 0.75 * len(q)


# --- truncated -------------------------------------------------------------

_HUNK = re.compile(r"^@@ -\d+(?:,(\d+))? \+\d+(?:,(\d+))? @@")
_ENDS = tuple(".!?:;\"'`)]}>…。！？»”’*|")
_LISTED = re.compile(r"^\s*(?:[-*+]|\d+[.)])\s*(.*)$")


def diff_breaks_off(answer: str, question: str) -> bool:
    """A unified diff whose last hunk has fewer lines than its header says, or ends inside a line of the file."""
    lines = answer.rstrip("\n").split("\n")
    old = new = 0
    hunks, last = 0, ""
    for line in lines:
        m = _HUNK.match(line)
        if m and old <= 0 and new <= 0:
            old, new, hunks = int(m.group(1) or 1), int(m.group(2) or 1), hunks + 1
        elif old > 0 or new > 0:
            if line.startswith("\\"):
                continue
            old -= not line.startswith("+")
            new -= not line.startswith("-")
            last = line
    if not hunks:
        return True
    if old > 0 or new > 0:
        if old == new and 0 < old <= 3 and last.startswith((" ", "-", "+", "")):
            # blank context lines at the end may have been stripped
            return not _blank_follows(question, last[1:], old)
        return True
    if last[:1] in (" ", "-") and last[1:].strip():
        body = last[1:]
        whole = question.split("\n")
        return body not in whole and any(x.startswith(body) for x in whole)
    return False


def _blank_follows(question: str, line: str, n: int) -> bool:
    lines = question.split("\n")
    return any(x == line and not "".join(lines[i + 1 : i + 1 + n]).strip("` \t") for i, x in enumerate(lines))


_FENCE_LINE = re.compile(r"[ \t>]*(`{3,}|~{3,})[ \t]*([\w+#.-]*)")
_CLOSES = {")": "(", "]": "[", "}": "{", "”": "“", "»": "«"}
_VOID = frozenset("area base br col embed hr img input link meta source track wbr p li td tr th dt dd".split())
_PROSE_TOKEN = re.compile(r"<!--|-->|<(/?)([a-zA-Z][\w-]*)(?:\s[^<>]*?)?(/?)>|[()\[\]{}“”«»]|\"")
_CODE_TOKEN = re.compile(r"\\.|\"\"\"|'''|//|/\*|\*/|--|#|[()\[\]{}\"'`\n]", re.S)
#: What begins a comment, by the label of a block of code; in a block without a known label ``#`` and ``//`` do.
_COMMENT = {**dict.fromkeys("python py python3 shell sh bash zsh ruby rb yaml yml toml".split(), ("#",)), "sql": ("--",), "": ("#", "//")}
_PROSE_BLOCKS = frozenset("text txt md markdown diff patch console log html xml svg plain".split())


def code_depth(code: str, label: str = "") -> list[str]:
    """Brackets, strings and comments of a piece of code that are still open at its end, outermost first."""
    comments = _COMMENT.get(label, ("//",))
    stack: list[str] = []
    inside = ""  # a string or comment
    for m in _CODE_TOKEN.finditer(code):
        t = m.group()
        if inside:
            if t == inside or (inside == "/*" and t == "*/") or (t == "\n" and inside in ("//", "#", "--", "\"", "'")):
                inside = ""
        elif t in ("\"\"\"", "'''", "\"", "`", "/*"):
            inside = t
        elif t == "'":
            if not (m.start() and code[m.start() - 1].isalnum()) and "'" in code[m.end() : m.end() + 200].split("\n", 1)[0]:
                inside = t  # neither an apostrophe nor a lifetime
        elif t in comments:
            inside = t
        elif t in "([{":
            stack.append(t)
        elif t in ")]}" and stack and stack[-1] == _CLOSES[t]:
            stack.pop()
    return [*stack, inside] if inside in ("\"\"\"", "'''", "/*") else stack


def left_open(text: str) -> tuple[list[str], list[str]]:
    """Pushdown parse of a whole answer: what is still open at its end, and the lines behind the last block of code.

    Fences hold code, whose brackets, strings and comments are parsed in their
    turn; a block that closes on open brackets leaves ``code``.  Outside, tags and
    comments stay open over paragraphs; brackets and quotations do not, as a text
    that goes on after them is not cut there.
    """
    fence, label, code = "", "", []
    tags: list[str] = []
    marks: list[str] = []
    cut_code = False
    tail: list[str] = []
    for line in text.split("\n"):
        m = _FENCE_LINE.match(line)
        if fence:
            if m and m.group(1).startswith(fence) and not m.group(2):
                cut_code = label not in _PROSE_BLOCKS and bool(code_depth("\n".join(code), label))
                fence, tail = "", []
            else:
                code.append(line)
            continue
        if m:
            fence, label, code, marks, tail = m.group(1), m.group(2).lower(), [], [], []
            continue
        tail.append(line)
        if not line.strip():
            marks = []
            continue
        cut_code = False
        plain = _INLINE.sub("x", line)
        for m in _PROSE_TOKEN.finditer(plain):
            t = m.group()
            comment = tags[-1:] == ["<!--"]
            if t == "-->" or comment:
                if t == "-->" and comment:
                    tags.pop()
            elif t == "<!--":
                tags.append(t)
            elif t[0] == "<":
                name = m.group(2).lower()
                if m.group(1):
                    if name in tags:
                        del tags[len(tags) - 1 - tags[::-1].index(name) :]
                elif not m.group(3) and name not in _VOID:
                    tags.append(name)
            elif t == '"':
                if marks[-1:] == [t]:
                    marks.pop()
                else:
                    marks.append(t)
            elif t in "([{“«":
                marks.append(t)
            elif t in _CLOSES and marks[-1:] == [_CLOSES[t]]:
                marks.pop()
        if plain.count("`") % 2:
            marks.append("`")
    closed = set(re.findall(r"</([a-zA-Z][\w-]*)>", text.lower()))
    tags = [t for t in tags if t == "<!--" or t in closed or re.search(rf"(?m)^\s*<{re.escape(t)}\b", text)]  # a lone <name> in a sentence is a word
    return [*tags, *marks, *([fence] if fence else []), *(["code"] if cut_code else [])], tail


def breaks_off(answer: str, question: str) -> bool:
    """Does the answer stop before its end: something left open, a half diff, list entry or sentence?"""
    text = answer.rstrip()
    head = text.lstrip()
    if head.startswith(("--- ", "diff --git ")):
        return diff_breaks_off(text.lstrip("\n"), question)
    left, lines = left_open(text)
    if any(x in ("<!--", "code") or x[0] in "`~" and len(x) >= 3 for x in left):
        return True
    tail = "\n".join(lines).rstrip()
    if not tail.strip():
        return bool(left) and left[0].isalpha()
    last = tail.split("\n")[-1]
    item = _LISTED.match(last)
    if item and not item.group(1).strip() and len(text) > 8:
        return True
    if re.search(r"<[a-zA-Z/][^<>]*$", last) and not re.search(r"\s<\s", last):
        return True
    if item and re.fullmatch(r"[\w./\\:<>~$-]+", item.group(1).strip()):
        token = item.group(1).strip()
        if re.search(rf"(?<![\w./]){re.escape(token)}(?![\w./-]|\.\w)", question):
            return False
        if token.isalpha() and any(len(_WORD.findall(x)) >= 4 for x in text.split("\n")[:-1]):
            return True  # a lone word where sentences stood before
        return re.search(rf"(?<![\w./]){re.escape(token)}[\w./-]", question) is not None or ("/" in token and "." not in token.rsplit("/", 1)[-1])
    if left:
        return True
    plain = _INLINE.sub("x", last)
    if len(_WORD.findall(text)) < 4:
        return False  # a short value; words after a code block are not one
    if last.rstrip().endswith(_ENDS):
        return last.rstrip().endswith((":", ";")) or (last.rstrip()[-1] in "*" and plain.count("*") % 2 == 1)
    return True


# --- wrong language ----------------------------------------------------------

# Function words of the human languages that are told apart.
FUNCTION_WORDS = {
    "en": "the and of to that with if is are was when which so must while a an this it for not be by from has have you your",
    "de": "der die das und nicht wenn mit einen eine ein den zu ist soll dem daher auch noch wird werden sich bei muss muß obwohl weil nach dass",
    "fr": "le la les et ne pas que un une dans avec est il faut donc chaque des du sur pour par plus mais ce cette si nous vous",
    "es": "el la los las y no que un una con es hay se para por cada cuando del así su sus pero como más porque ya desde al lo hasta sin sobre entre también",
    "it": "il lo gli e non che un una con è per di della sono ogni quando anche più ma come questo nel",
    "pt": "o os as e não que um uma com é para por cada quando do da mas como mais porque já seu sua no na",
    "nl": "de het en niet als met een zijn is voor van dat te op ook wordt maar bij naar nog elke",
}
# Endings that only words of one of these languages have.
_ENDINGS = {"es": ("ción", "sión", "ciones", "miento", "dades"), "pt": ("ção", "são", "ções", "dade"), "it": ("zione", "zioni", "tà"), "de": ("ung", "keit", "heit", "ungen"), "nl": ("heid", "lijk")}
_WORDS_OF = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}
_HUMAN = {
    "en": r"english|englisch\w*|anglais\w*|ingl[eé]s\w*|inglese", "de": r"german|deutsch\w*|allemand\w*|alem[aá]n\w*|tedesco",
    "fr": r"french|franz[oö]sisch\w*|français\w*|franc[eé]s\w*|francese", "es": r"spanish|spanisch\w*|espagnol\w*|español\w*|castellano|spagnolo",
    "it": r"italian\w*|italienisch\w*|italien\w*", "pt": r"portuguese|portugiesisch\w*|portugais\w*|portugu[eê]s\w*", "nl": r"dutch|niederländisch\w*|néerlandais\w*",
    "ru": r"russian|russisch\w*|russe|ruso", "zh": r"chinese|chinesisch\w*|chinois\w*|chino", "ja": r"japanese|japanisch\w*|japonais\w*|japon[eé]s",
}
_ASKED_HUMAN = {k: re.compile(rf"(?i)\b(?:{v})\b") for k, v in _HUMAN.items()}


def human_language(text: str) -> tuple[str | None, int]:
    """Language of a prose and how clear it is; by script where it is not Latin, else by function words."""
    words = _LETTERS.findall(text.lower())
    if not words:
        return None, 0
    other = [w for w in words if ord(w[0]) > 0x24F]
    if len(other) > 0.5 * len(words) and len(other) >= 2:
        c = other[0][0]
        name = unicodedata.name(c, "").split(" ")[0]
        return {"CYRILLIC": "ru", "CJK": "zh", "HIRAGANA": "ja", "KATAKANA": "ja", "HANGUL": "ko"}.get(name, name.lower()), len(other)
    score = {k: sum(w in v for w in words) + sum(w.endswith(_ENDINGS.get(k, ())) for w in words if len(w) > 5) for k, v in _WORDS_OF.items()}
    best = max(score, key=score.get)
    second = max(v for k, v in score.items() if k != best)
    return (best, score[best] - second) if score[best] >= 2 and score[best] > second else (None, 0)


_CODE_NAMES = {
    "python": r"Python3?", "javascript": r"JavaScript|JS|Node(?:\.js)?", "typescript": r"TypeScript|TS", "java": r"Java", "cpp": r"C\+\+|CPP",
    "go": r"Go|Golang", "rust": r"Rust", "sql": r"SQL", "shell": r"[Ss]hell|Bash|bash", "csharp": r"C#", "ruby": r"Ruby", "php": r"PHP", "kotlin": r"Kotlin",
    "swift": r"Swift", "scala": r"Scala",
}
_ANY_NAME = "|".join(f"(?P<{k}>{v})" for k, v in _CODE_NAMES.items())
_ASKED_CODE = [
    re.compile(rf"\b(?:[Ii]nto|[Ii]n|to|[Uu]sing|en|auf|mit)\s+(?:{_ANY_NAME})(?![\w+#])(?!\s+(?:service|helper|version of))"),
    re.compile(rf"(?<![\w/.-])(?:{_ANY_NAME})(?![\w+#])[ -](?:function|routine|code|program|script|method|class|implementation|snippet|query|[Ff]unktion|[Cc]ode)"),
    re.compile(rf"\b(?:función|fonction|programa|programme|código|code|script|rutina)\s+(?:en\s+)?(?:{_ANY_NAME})(?![\w+#])"),
    re.compile(rf"(?<![\w/.-])(?:{_ANY_NAME})(?![\w+#])\s+(?:service|helper|module|library|Dienst|Modul)"),
]
_LABELS = LANGUAGE_SPELLINGS | {"node": "javascript", "zsh": "shell", "cs": "csharp", "c#": "csharp", "rb": "ruby", "kt": "kotlin"}
_SIGNS = {
    k: re.compile(v, re.M)
    for k, v in {
        "python": r"^[-+ ]?\s*(?:def \w+\(.*\).*:|(?:for|if|while|with|elif|else)\b[^{};]*:)\s*$|\braise \w+\(|^[-+ ]?\s*(?:from \w[\w.]* import|import \w+$)|^[-+ ]?\s*assert .*, \"",
        "go": r"^[-+ ]?\s*func .*\{\s*$|:= |\bfmt\.|\breturn \w+, nil\b|^package \w+|\bdefer \w+",
        "rust": r"\bfn \w+\s*[<(].*\{\s*$|\blet mut\b|\bVec<|\bpanic!\(|\.iter\(\)|^[-+ ]?\s*let \w+ = .*;\s*$(?<!new )",
        "java": r"\bpublic static\b|\bnew ArrayList<|\bthrow new Illegal\w+|^[-+ ]?\s*List<\w+> \w+ =|\blog\.info\(|\.removeIf\(",
        "cpp": r"\bstd::|^[-+ ]?#include\b|\bconst auto&",
        "typescript": r"\bexport function\b.*\)\s*:\s*[\w\[\]<>]+ \{|: Record<string|\bas number\b|:\s*\w+\[\] =|\(\w+: \w+(?:\[\])?[,)]|=== undefined",
        "javascript": r"^[-+ ]?\s*(?:export )?function \w+\([^:]*\) \{|\bconsole\.log\(|\bnew Map\(|\bconst \w+ = .*=>|\.forEach\(\(",
        "sql": r"(?i)\bselect\b.+\bfrom\b|^\s*(?:insert into|update \w+ set|delete from|create table|alter table)\b",
        "shell": r"^#!.*sh\b|^[-+ ]?\s*\w+\(\) \{\s*$|^\s*local \w+=|\[ \"\$|^\s*echo \"|^\s*(?:fi|done)\s*$",
    }.items()
}
_FAMILY = {"typescript": {"typescript", "javascript"}, "javascript": {"javascript", "typescript"}}


def code_language(code: str) -> tuple[str | None, int]:
    """Programming language whose signatures occur on most lines, and its lead over the next."""
    score = {k: len(p.findall(code)) for k, p in _SIGNS.items()}
    best = max(score, key=score.get)
    rest = max((v for k, v in score.items() if k != best and k not in _FAMILY.get(best, ())), default=0)
    return (best, score[best] - rest) if score[best] > rest else (None, 0)


def asked_code(question: str) -> str | None:
    """Programming language that the question asks for; None where it names none."""
    text = _FENCED.sub("\n", question)
    for pattern in _ASKED_CODE:
        found = [next(k for k, v in m.groupdict().items() if v) for m in pattern.finditer(text)]
        if found:
            return found[-1] if pattern is _ASKED_CODE[0] else found[0]
    return None


def is_wrong_language(question: str, answer: str) -> bool:
    """Prose in a human language that the question is not in and does not ask for, or code in another language than asked."""
    is_diff = answer.lstrip().startswith(("--- ", "diff --git "))
    blocks = [] if is_diff else [(m.group(2).lower(), m.group(3)) for m in _FENCED.finditer(answer)]
    if not is_diff:
        said, clear = human_language(prose(answer))
        if said and clear >= 1:
            natural = prose(question)
            of, sure = human_language(natural)
            asked = {k for k, p in _ASKED_HUMAN.items() if p.search(natural)}
            if of and sure >= 1 and said != of and said not in asked:
                return True
    if blocks:
        wanted = asked_code(question)
        if wanted:
            fits = _FAMILY.get(wanted, {wanted})
            for label, code in blocks:
                label = _LABELS.get(label, label)
                guess, lead = code_language(code)
                if label == wanted or (label in fits and not label == ""):
                    if guess is None or guess in fits or lead < 3:
                        return False
                elif label in _CODE_NAMES:
                    if guess is None or guess not in fits or lead < 2:
                        continue
                    return False
                elif guess is None or guess in fits or lead < 2:
                    return False
            return True
    if is_diff:
        path = re.search(r"(?m)^\+\+\+ (?:b/)?\S*?\.(\w+)\s*$", answer)
        lang = _LABELS.get(path.group(1), path.group(1)) if path else None
        lang = {"h": "cpp", "hpp": "cpp", "mjs": "javascript"}.get(lang, lang)
        if lang in _SIGNS:
            body = "\n".join(x for x in answer.split("\n") if x[:1] in "+ " and not x.startswith("+++"))
            guess, lead = code_language(body)
            return guess is not None and guess not in _FAMILY.get(lang, {lang}) and lead >= 4 and not _SIGNS[lang].search(body)
    return False


# --- the operator ------------------------------------------------------------


def defect(messages: list[tuple[str | None, str | None]] | None) -> str | None:
    """Defect of the pair of the last user message and the last message; None where the answer is proper."""
    if not messages:
        return "empty"
    role, answer = messages[-1]
    if role != "assistant" or is_empty(answer):
        return "empty"
    question = next((c for r, c in reversed(messages) if r == "user"), None) or ""
    if is_refusal(answer, question):
        return "refusal"
    if question and is_echo(question, answer):
        return "echo"
    if breaks_off(answer, question):
        return "truncated"
    if question and is_wrong_language(question, answer):
        return "wrong_language"
    return None


def pair_defect(messages: Column) -> Column:
    """Defect of each row's messages as string, null where there is none."""

    @F.arrow_udf("string")
    def judge(col: pa.Array) -> pa.Array:
        flat = col.flatten()
        role, content = (flat.field(f).to_pylist() for f in ("role", "content")) if len(flat) else ([], [])
        out, at = [], 0
        for n in pa.compute.fill_null(pa.compute.list_value_length(col), 0).to_pylist():
            out.append(defect(list(zip(role[at : at + n], content[at : at + n]))))
            at += n
        return pa.array(out, pa.string())

    return judge(messages)


def broken_pairs(examples: DataFrame) -> DataFrame:
    """``id, defect`` of every example whose answer is broken.

    An example delivered several times is judged by its latest copy.  Null or
    missing messages, a null answer and a last message that is not an
    assistant's are ``empty``; rows without id cannot be named and are left out.
    Texts are judged where they are scanned; only ids and verdicts are shuffled.
    """
    judged = examples.where("id is not null").select("id", "loaded_at", pair_defect(F.col("messages")).alias("defect"))
    return latest_copy(judged, "id", ["loaded_at"]).where("defect is not null").select("id", "defect")
