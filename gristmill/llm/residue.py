"""Problem 8: template residue, filler, error pages and script notices.

Two regularized linear classifiers on hashed n-grams, lengths and title
features judge a document: one its pieces (lines, long ones in overlapping
stretches), for slots and filler that stand beside real paragraphs, the other
the whole page, for errors and notices, which must be what the page consists
of.  Both also see how much a text repeats itself and the shapes that signs
give it (``{a}``, ``<a-a>``), so neither depends on a wording or a syntax.
They are trained here, on weak labels from response-status and phrase patterns
over a bounded sample.  The patterns are labels and never an input, and they
are known to miss cases, so texts that the first fit takes for residue are no
examples of real content in the second.  Lines in code, in quotes or about such
things are what the classifiers have to tell from the real ones.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.wordhash import mix

KINDS = ("none", "placeholder", "filler", "error_page", "script_notice")
#: Hash buckets of the features.
BUCKETS = 1 << 16
#: Documents of the training sample: the bound of what the driver holds.
SAMPLE_DOCS = 12_000
#: Pieces and pages without residue that the training keeps at most.
PLAIN_PIECES, PLAIN_PAGES = 20_000, 6_000
#: Strength of the ridge penalty, passes over the sample, rows of a step, and learning rate.
RIDGE, EPOCHS, STEP_ROWS, RATE = 1e-5, 4, 128, 0.3
#: A text of the sample that the first fit takes for residue with this chance is not used as real content.
DOUBTFUL = 0.3
#: Chance from which a piece, or a page of slots or filler, is residue, and from which a page is an error or notice.
PIECE_SURE, PAGE_SURE = 0.6, 0.35
#: Of the hosts, one in this many is kept for validation.
HELD_OUT = 5
#: Parts of the phrase families, each held out in turn by the validation.
FOLDS = 4
#: Documents that are judged together.
DOCS_AT_ONCE = 256
#: Words of a stretch that is judged at once: twice the step from one stretch of a long line to the next.
HALF = 20
#: Share of a page's letters that an error or notice pattern must name to label the page.
NAMED_SHARE = 0.25

# --- weak labels ---------------------------------------------------------------

_NAME = r"[A-Za-z][\w .?-]{1,50}"
_VERB = r"(?:insert|add|write|describe|explain|enter|put|fill in|replace|list|name|state|give|link|your)"
# Phrase families that label training texts, by kind.  They need not be complete: the classifiers carry them on.
FAMILIES = {
    "placeholder": [
        rf"\{{\{{\s*[\w.\- ]{{1,60}}\s*\}}\}}|\$\{{[\w.]{{1,60}}\}}|#\{{[\w.]{{1,60}}\}}|(?<![\w\"'\\]){{[a-z]+_?[a-z_]*}}(?!\w)",
        r"<%=?\s*[\w. ]{1,60}\s*%>|\{%\s*\w[^%\n]*%\}|%\([\w]{1,60}\)[sd]",
        r"(?<![\w_])__[A-Z][A-Z0-9_]*?__(?![\w_])|@@[A-Z_]{2,}@@|%[A-Z][A-Z_]{2,}%|(?<!\w)X{4,}(?!\w)",
        rf"\[\[\s*{_NAME}\s*\]\](?!\()",
        rf"(?i:<(?:your|insert|enter|add|the|describe|replace|put|fill in)[ _-][\w .,'_-]{{1,60}}>)|<{_NAME} (?:goes )?here>",
        rf"(?i:\[(?:todo|tbd|placeholder)\b[^\]\n]*\](?!\())|(?i:\[{_VERB}\b[^\]\n]{{2,90}}\](?!\())",
        rf"(?i:^\W*\({_VERB}\b[^)\n]{{2,90}}\)\W*$)|(?i:^\W*_{_VERB}\b[^\n]{{2,90}}_\W*$)",
        r"\[object Object\]|(?i:^[ \t]*[a-z][\w ]{0,30}:\s*(?:undefined|null|nan|none)[ \t]*$)",
    ],
    "filler": [
        r"(?i)^\W*(?:lorem ipsum|dolor sit amet|consectetur)",
        r"(?i)\b(?:goes|will (?:appear|go|stand|follow)) (?:here|in this place)\W*$|\b(?:viendra|apparaîtra|sera) ici\b|\b(?:aquí|acá) (?:irá|va|aparecerá)\b|\b(?:irá|va|aparecerá) aquí\W*$",
        r"(?i)\b(?:dummy|sample|placeholder|filler) (?:paragraph )?(?:content|text)\b|\b(?:blindtext|platzhaltertext)\b|\bfaux texte\b|^\W*(?:texto|contenido) (?:de )?(?:relleno|provisional|ficticio|pendiente|de prueba)|^\W*contenu (?:provisoire|à venir|fictif)",
        r"(?i)^\W*(?:nothing (?:here|to see) yet|(?:content|text|more|page) (?:is )?coming soon|coming soon|(?:this )?(?:page|site|section) (?:is )?under construction)\W*$|\bbientôt disponible\W*$|^\W*(?:page|site) en construction|^\W*p[aá]gina en construcci[oó]n|^\W*(?:pr[oó]ximamente|en construcci[oó]n)\W*$",
        r"(?i)\bto be (?:written|added|done|filled in|completed|announced)\W*$|\bintentionally left blank\b|\breplace (?:this|the) (?:text|paragraph|content)\b",
        r"(?i)\bhier (?:steht|folgt|kommt|entsteht)\b|^\W*(?:inhalt|diese seite|seite|text)\b.{0,20}\b(?:folgt|im aufbau|in bearbeitung)\b|^\W*(?:noch nichts hier|noch kein inhalt)|^\W*(?:rien ici|todavía no hay nada|aún no hay nada)",
    ],
    "error_page": [
        r"(?i)^\W*(?:error|erreur|fehler|http)\s*:?\s*[1-5]\d\d\b|^\W*[45]\d\d\b\W*[a-z][a-z' -]{2,30}$|\"?(?:status|code|error)\"?\s*:\s*\"?[45]\d\d\b|<title>\s*[45]\d\d\b",
        r"(?i)^\W*(?:access|permission) denied\b|^\W*(?:zugriff verweigert|accès refusé|acceso denegado)\b|\b(?:session|sitzung|sesión)\b.{0,20}\b(?:expired|abgelaufen|expiré|caducado)\b",
        r"(?i)\b(?:we couldn['’]t find (?:that|this) page|the page you (?:were looking for|requested)|page not found|la page demandée|die angeforderte seite|no se encontró la página|page introuvable|seite nicht gefunden|página no encontrada)",
        r"(?i)\b(?:this \w+ is (?:temporarily|currently) unavailable|this file is too large to display|internal server error|service unavailable|bad gateway|too many requests|rate limit exceeded)\b",
        r"(?i)^\W*(?:oops\W+|whoops\W+|sorry\W+|uh oh\W+)?(?:something went wrong|an error (?:has )?occurred)|^\W*(?:une erreur|ein fehler ist|se ha producido un error)|\b(?:we have|our team has) been notified\b",
        r"(?i)\bconnection to database failed\b|^\W*(?:fatal|uncaught|unhandled) (?:error|exception)\b|\btraceback id\b|^\W*traceback \(most recent",
    ],
    "script_notice": [
        r"(?i)\b(?:javascript|scripts?|skripte?|scripting|js)\b.{0,60}\b(?:disabled|off|blocked|required|needed|blockiert|deaktiviert|bloque(?:nt|ados?|ado)?|désactivé|desactivad\w+)\b",
        r"(?i)\b(?:enable|turn on|activate|allow|aktivieren sie|activer|active|activez|habilite|permita|erlauben sie|autoriser)\b.{0,20}\b(?:javascript|scripts?|scripting)\b",
        r"(?i)\b(?:requires?|needs?|nécessite|requiere|necesita|benötigt|braucht)\b.{0,25}\b(?:javascript|scripts?|skripte?|scripting)\b|\bonly works with (?:active )?(?:scripting|javascript)\b",
        r"(?i)^\W*checking your browser|\bscripts and cookies must be allowed\b|<noscript>",
    ],
}
# What a line must hold, in lower case, for a family's pattern to match; the patterns are tried only there.
_HOLDS = {
    "placeholder": ["{", "<% {% %(", "__ @@ % xxxx", "[[", "<", "[", "( _", "[object undefined null nan none"],
    "filler": ["lorem dolor consectetur", "here place ici aquí acá", "text conten", "nothing soon construc disponible próximamente proximamente", "to be intentionally replace", "hier folgt aufbau bearbeitung noch rien todavía aún"],
    "error_page": ["4 5 error erreur fehler http", "denied verweigert refusé denegado session sitzung sesión", "page seite página", "unavailable large internal gateway many rate", "wrong occurred erreur fehler error notified", "connection fatal uncaught unhandled traceback"],
    "script_notice": ["script skript js", "script", "script skript", "browser script"],
}
_FAMILIES = [(KINDS.index(k), i, re.compile(p), _HOLDS[k][i].split()) for k, ps in FAMILIES.items() for i, p in enumerate(ps)]
#: Sentences that talk about such things: a subject of its own, and a verb that acts on them.
_ABOUT = re.compile(
    r"(?i)\b(?:tells? readers|we filled|our \w+ templates|gets? an? \d{3}|is treated as|returns? an? \d{3}|the call\b|there is an? todo|responds? with|throws?|logs?|retries|tries \d+|when the (?:server|user)|if the (?:server|user|page)|for example|such as|e\.g\.|so that|yet our)\b"
)
#: A text of at least so many words is filler if its different words are no more than this share of them, or of MANY words in a longer one.
REPEATING, FEW, MANY = 12, 0.15, 80

_FENCE = re.compile(r"(?ms)^[ \t>]*(`{3,}|~{3,}).*?(?:^[ \t>]*\1[ \t]*$|\Z)")
_INLINE = re.compile(r"`[^`\n]*`")
_QUOTED = re.compile(r"[\"“«][^\"“”«»\n]*[\"”»]")
_SET_APART = re.compile(r"(?m)^(?:[ \t]*>| {4}|\t).*$")
_MARKUP_LINE = re.compile(r"\s*(?:[-*]\s+)?[{<\[]")
_WORD = re.compile(r"[^\W_]+")


def visible(text: str) -> str:
    """What a reader sees as prose: code, block quotes and quotations off, lines trimmed, blank lines gone."""
    if "```" in text or "~~~" in text:
        text = _FENCE.sub("\n", text)
    if "`" in text:
        text = _INLINE.sub(" CODE ", text)
    if ">" in text or "    " in text or "\t" in text:
        text = _SET_APART.sub("", text)
    if any(c in text for c in '"“«'):
        lines = []
        for line in text.split("\n"):
            bare = line.strip()
            if bare[:1] in "\"“«" and bare[-1:] in "\"”»" and len(bare) > 1:
                bare = bare[1:-1]  # a whole line in quotation marks is not a quotation inside a sentence
            lines.append(bare if _MARKUP_LINE.match(bare) else _QUOTED.sub(" QUOTED ", bare))
        text = "\n".join(lines)
    return "\n".join(x for x in map(str.strip, text.split("\n")) if x)


def weak_label(line: str) -> tuple[int, int]:
    """Kind and family of a visible line by the patterns; kind 0 where none matches, -1 where the line talks about such things."""
    low = line.lower()
    for kind, family, pattern, holds in _FAMILIES:
        if any(x in low for x in holds) and pattern.search(line):
            return (-1, family) if _ABOUT.search(line) else (kind, family)
    return 0, 0


def repeats(text: str) -> bool:
    """A text of a few different words, said over and over."""
    words = [w.lower() for w in _WORD.findall(text)]
    return len(words) >= REPEATING and len(set(words)) <= max(2, FEW * min(len(words), MANY))


# --- features --------------------------------------------------------------------

_N = 0x10000
_chars = [chr(i) if not 0xD800 <= i < 0xE000 else "?" for i in range(_N)]
_LOWER = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in _chars], np.uint32)
#: Class of a character: 1 white space, 2 letter, 3 capital, 4 digit, else the sign itself.
_CLASS = np.array([1 if c.isspace() else 4 if c.isdigit() else 3 if c.isupper() else 2 if c.isalpha() else ord(c) + 8 for c in _chars], np.uint32)
_U = np.uint64
_BASE, _P1, _P2, _P3 = _U(0x100000001B3), _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)
_POW = np.multiply.accumulate(np.concatenate([[1], np.full(1 << 12, 0x100000001B3, np.uint64)]).astype(np.uint64))
_SHARES = 8


def _named(name: str, value: np.ndarray) -> np.ndarray:
    """Feature of a name with a small whole number."""
    h = 0
    for b in name.encode():
        h = (h * 131 + b) & ((1 << 64) - 1)
    return mix(_U(h) + value.astype(np.uint64) * _P1)


def _octave(n: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(n + 1.0)).astype(np.int64)


@dataclass
class Features:
    """Pieces of some texts: bucket lists end to end, where each piece's begin, and the text and line of each piece."""

    bucket: np.ndarray
    at: np.ndarray
    doc: np.ndarray
    line: np.ndarray
    pages: tuple[np.ndarray, np.ndarray]


def _lists(owner: np.ndarray, hashes: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each owner, end to end, and the offsets of the owners."""
    key = np.sort(owner.astype(np.int64) * BUCKETS + (mix(hashes) >> _U(48)).astype(np.int64) % BUCKETS)
    key = key[np.diff(key, prepend=-1) > 0]
    return (key % BUCKETS).astype(np.int32), np.searchsorted(key // BUCKETS, np.arange(owners + 1))


def features(shown: list[str]) -> Features:
    """Features of visible texts, by array operations over the characters of all of them.

    A piece has its words' 1- to 3-grams, the shapes around its signs, its
    length and place as a title, how often its line occurs in the text, the
    number of lines, and whether the text hardly has different words.  A page
    has the n-grams, shapes and line features of all its pieces, its lengths, and
    its share of different words.
    """
    with np.errstate(over="ignore"):
        return _features(shown)


def _features(shown: list[str]) -> Features:
    docs = len(shown)
    joined = "\n".join(shown) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(code < _N, code, 0xFFFD)
    cls = _CLASS[code]
    newline = code == 10
    line_of = np.cumsum(newline) - newline  # line of each character
    n_lines = int(newline.sum())
    lines_in = np.array([s.count("\n") + 1 for s in shown], np.int64)
    doc_of = np.repeat(np.arange(docs), lines_in)
    ends = np.flatnonzero(newline)
    starts = np.concatenate([[0], ends[:-1] + 1]) if n_lines else ends
    first_of = np.concatenate([[0], np.cumsum(lines_in)[:-1]]) if docs else np.zeros(0, np.int64)

    # words: runs of letters and digits; a number is one word, whatever its digits
    inside = (cls >= 2) & (cls <= 4)
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = b - a
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    value = (_LOWER[code[inside]].astype(np.uint64) + _U(1)) * _POW[place & 0xFFF]
    word = mix(np.add.reduceat(value, np.cumsum(n) - n)) if len(a) else np.zeros(0, np.uint64)
    word = np.where(cls[a] == 4, _U(0x30), word) if len(a) else word
    w_line = line_of[a]
    w_doc = doc_of[w_line] if len(a) else w_line
    words_in = np.bincount(w_line, minlength=n_lines)
    w_at = np.arange(len(word)) - (np.cumsum(words_in) - words_in)[w_line]

    # pieces: stretches of 2 HALF words, each beginning HALF after the one before
    parts = np.maximum(1, -(-words_in // HALF) - 1)
    piece_0 = np.cumsum(parts) - parts
    pieces = int(parts.sum())
    p_line = np.repeat(np.arange(n_lines), parts)
    p_doc = doc_of[p_line] if n_lines else p_line
    owner, feats = [], []

    def of_words(line: np.ndarray, at: np.ndarray, h: np.ndarray) -> None:
        k = np.minimum(at // HALF, parts[line] - 1)
        owner.append(piece_0[line] + k)
        feats.append(h)
        again = (at // HALF >= 1) & (k >= 1) & (at // HALF <= parts[line] - 1)
        owner.append((piece_0[line] + k - 1)[again])
        feats.append(h[again])

    of_words(w_line, w_at, word)
    if len(a):  # endings: dummy words are made with those of a language
        last = b - 1
        of_words(w_line, w_at, mix((_LOWER[code[last]].astype(np.uint64) * _P2 + _LOWER[code[np.maximum(last - 1, a)]]) * _P3 + _U(13)))
    two = np.flatnonzero(w_line[1:] == w_line[:-1])
    of_words(w_line[two], w_at[two], mix(word[two] * _P1 + word[two + 1]))
    three = np.flatnonzero(w_line[2:] == w_line[:-2])
    of_words(w_line[three], w_at[three], mix(mix(word[three] * _P1 + word[three + 1]) * _P2 + word[three + 2]))

    # shapes: classes with runs as one; windows of 2 to 5 that begin or end at a sign
    keep = np.ones(len(cls), bool)
    keep[1:] = (cls[1:] != cls[:-1]) | (cls[1:] > 8)
    at = np.flatnonzero(keep & ~newline)
    c, l = cls[at].astype(np.uint64), line_of[at]
    before = np.searchsorted(a, at, "right") - 1  # the word at or before each shape character
    near = np.where((before >= 0) & (w_line[np.maximum(before, 0)] == l), w_at[np.maximum(before, 0)], 0) if len(a) else np.zeros(len(at), np.int64)
    sign = c > 8
    h = c + _U(1)
    for k in range(1, 5):
        if len(c) <= k:
            break
        h = mix(h[:-1] * _P3 + c[k:])
        ok = (l[k:] == l[:-k]) & (sign[k:] | sign[:-k])
        i = np.flatnonzero(ok)
        of_words(l[i], near[i], h[i] + _U(k))

    # lengths, title and repetition
    lo = np.searchsorted(line_of, np.arange(n_lines)) if n_lines else starts
    head, tail = code[starts], code[np.maximum(ends - 1, starts)]
    nth = np.arange(n_lines) - first_of[doc_of]
    sums = np.zeros(n_lines, np.uint64)
    np.add.at(sums, w_line, mix(word + w_at.astype(np.uint64) * _P2))
    same = np.unique(np.stack([doc_of.astype(np.uint64), sums]), axis=1, return_inverse=True, return_counts=True) if n_lines else None
    times = same[2][same[1].ravel()] if n_lines else np.zeros(0, np.int64)
    key = np.unique(w_doc.astype(np.uint64) * _P1 ^ word)
    distinct = np.bincount(np.unique(np.stack([w_doc.astype(np.uint64), word]), axis=1)[0].astype(np.int64), minlength=docs) if len(word) else np.zeros(docs)
    del lo, key
    doc_words = np.bincount(w_doc, minlength=docs) if len(word) else np.zeros(docs, np.int64)
    variety = np.floor(_SHARES * distinct / np.maximum(doc_words, 1)).astype(np.int64)
    chars = np.array([len(s) for s in shown], np.int64)
    long = doc_words >= REPEATING
    page_extra = [
        _named("lines", _octave(lines_in)), _named("chars", _octave(chars)), _named("words", _octave(doc_words)),
        _named("variety", variety * 64 + _octave(doc_words)), _named("few", ((distinct <= np.maximum(2, FEW * np.minimum(doc_words, MANY))) & long).astype(np.int64)),
    ]
    line_extra = [
        _named("line words", _octave(words_in)), _named("title", (nth == 0) * 2 + (head == 35)), _named("alone", (lines_in[doc_of] == 1).astype(np.int64)),
        _named("times", np.minimum(times, 4)), _named("ends", tail.astype(np.int64) * (_CLASS[np.minimum(tail, _N - 1)] > 8)),
        _named("wrap", (head.astype(np.int64) * 0x10000 + tail) * ((_CLASS[np.minimum(head, _N - 1)] > 8) & (_CLASS[np.minimum(tail, _N - 1)] > 8))),
    ]
    if len(word):
        has = np.flatnonzero(words_in)
        line_first = np.cumsum(words_in) - words_in
        w1 = word[line_first[has]]
        w2 = np.where(words_in[has] > 1, word[np.minimum(line_first[has] + 1, len(word) - 1)], _U(0))
        owner.append(piece_0[has])
        feats.append(mix(w1 * _P3 + w2 * _P1 + _U(11)))
        e1 = word[line_first[has] + words_in[has] - 1]
        e2 = np.where(words_in[has] > 1, word[np.maximum(line_first[has] + words_in[has] - 2, 0)], _U(0))
        owner.append(piece_0[has] + parts[has] - 1)
        feats.append(mix(e1 * _P2 + e2 * _P1 + _U(12)))
    n_grams = np.concatenate(owner), np.concatenate(feats)
    for x in line_extra:
        owner.append(np.arange(pieces))
        feats.append(x[p_line])
    for x in (page_extra[0], page_extra[-1]):
        owner.append(np.arange(pieces))
        feats.append(x[p_doc])
    bucket, offsets = _lists(np.concatenate(owner), np.concatenate(feats), pieces)
    page = _lists(
        np.concatenate([p_doc[n_grams[0]], *[doc_of] * len(line_extra), *[np.arange(docs)] * len(page_extra)]),
        np.concatenate([n_grams[1], *line_extra, *page_extra]), docs,
    )
    return Features(bucket, offsets, p_doc, p_line, page)


def _together(parts: list[Features]) -> Features:
    """Features of all parts, their texts and lines counted on."""
    end_to_end = lambda xs: (np.concatenate([b for b, _ in xs]), np.concatenate([[0], *[np.diff(a) for _, a in xs]]).cumsum())
    count_on = lambda xs, n: np.concatenate([x + k for x, k in zip(xs, np.cumsum([0, *n[:-1]]))])
    docs = [len(p.pages[1]) - 1 for p in parts]
    lines = [int(p.line[-1]) + 1 if len(p.line) else 0 for p in parts]
    return Features(*end_to_end([(p.bucket, p.at) for p in parts]), count_on([p.doc for p in parts], docs), count_on([p.line for p in parts], lines), end_to_end([p.pages for p in parts]))


# --- the classifiers -------------------------------------------------------------


@dataclass
class Linear:
    """A linear classifier: weights by bucket and kind, and a bias.  A text's features share out a weight of one."""

    weights: np.ndarray
    bias: np.ndarray

    def chances(self, bucket: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Probability of each kind for every text."""
        n = np.diff(at)
        z = np.zeros((len(n), len(KINDS)))
        some = np.flatnonzero(n)
        if len(some):
            z[some] = np.add.reduceat(self.weights[bucket].astype(np.float64), at[:-1][some], axis=0) / np.sqrt(n[some])[:, None]
        z += self.bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def _pick(bucket: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = at[rows + 1] - at[rows]
    to = np.concatenate([[0], np.cumsum(n)])
    return bucket[np.repeat(at[rows] - to[:-1], n) + np.arange(to[-1])], to


def fit_linear(bucket: np.ndarray, at: np.ndarray, y: np.ndarray, rng: np.random.Generator, epochs: int = EPOCHS) -> Linear:
    """Multinomial logistic regression with a ridge penalty, by AdaGrad in small steps; rare kinds weigh more."""
    k = len(KINDS)
    w, b, gw = np.zeros((BUCKETS, k)), np.zeros(k), np.full((BUCKETS, k), 1e-6)
    counts = np.bincount(y, minlength=k)
    heft = np.sqrt(counts.max(initial=1) / np.maximum(counts, 1)).clip(1, 8)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), STEP_ROWS):
            rows = order[i : i + STEP_ROWS]
            x, to = _pick(bucket, at, rows)
            n = np.diff(to)
            scale = 1 / np.sqrt(np.maximum(n, 1))
            z = np.add.reduceat(w[x], to[:-1], axis=0) * scale[:, None] + b
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= heft[y[rows]][:, None]
            u, inv = np.unique(x, return_inverse=True)
            share = np.repeat(p * scale[:, None], n, axis=0)
            g = np.stack([np.bincount(inv, share[:, j], len(u)) for j in range(k)], axis=1) + RIDGE * w[u]
            gw[u] += g * g
            w[u] -= RATE * g / np.sqrt(gw[u])
            b -= 0.01 * p.mean(axis=0)
    return Linear(w.astype(np.float32), b)


@dataclass
class Residue:
    """The classifier of pieces and the one of pages."""

    piece: Linear
    page: Linear


def labels(shown: str) -> tuple[int, set[tuple[int, int]], list[int]]:
    """Weak label of a page, the families that gave it, and the label of each line.

    A page is what it has a slot or filler line for; an error or notice must be
    a fair share of it, else the page is left out (-1).  So is each line
    without a label beside one that has one.
    """
    lines = shown.split("\n")
    found = [weak_label(x) for x in lines]
    kinds = {k for k, _ in found if k > 0}
    if repeats(shown):
        return 2, {(2, -1)}, [2] * len(lines)
    if not kinds:
        return 0, set(), [max(k, 0) for k, _ in found]
    page = next(k for k in (1, 4, 3, 2) if k in kinds)
    if page in (3, 4):
        of = sum(len(x) for x, (k, _) in zip(lines, found) if k in (3, 4))
        page = page if of >= NAMED_SHARE * len(shown) else -1
    return page, {x for x in found if x[0] > 0}, [k if k > 0 else 0 if k < 0 else -1 for k, _ in found]


def fit(texts: list[str], seed: int = 3407, without: int | None = None) -> Residue:
    """Both classifiers from weakly labelled texts; ``without`` leaves out every ``FOLDS``-th phrase family, with all texts that it labels."""
    rng = np.random.default_rng(seed)
    shown, page_y, line_y = [], [], []
    for text in texts:
        s = visible(text)
        page, families, lines = labels(s)
        if without is not None and any((k + f) % FOLDS == without for k, f in families):
            continue
        shown.append(s)
        page_y.append(page)
        line_y += lines
    if not shown:
        shown, page_y, line_y = [""], [0], [0]
    f = _together([features(shown[at : at + DOCS_AT_ONCE]) for at in range(0, len(shown), DOCS_AT_ONCE)])
    page_y = np.array(page_y)
    y = np.array(line_y)[f.line]
    y[(y > 0) & (np.bincount(f.line)[f.line] > 1)] = -1  # of a long line it is not said where the phrase stands
    models = []
    for (bucket, at), target, most in (((f.bucket, f.at), y, PLAIN_PIECES), (f.pages, page_y, PLAIN_PAGES)):
        use = np.concatenate([rng.permutation(np.flatnonzero(target == 0))[:most], np.flatnonzero(target > 0)])
        # each half is judged by the fit of the other: what looks like residue there is not taken for real content
        half = rng.integers(0, 2, len(use))
        sure = np.ones(len(use), bool)
        for side in (0, 1):
            seen, other = use[half != side], np.flatnonzero(half == side)
            if len(seen) and len(other):
                m = fit_linear(*_pick(bucket, at, seen), target[seen], rng, EPOCHS // 2)
                sure[other] = (target[use[other]] > 0) | (m.chances(*_pick(bucket, at, use[other]))[:, 0] >= 1 - DOUBTFUL)
        kept = use[sure]
        models.append(fit_linear(*_pick(bucket, at, kept), target[kept], rng))
    return Residue(*models)


def judge(model: Residue, texts: list[str | None]) -> list[str | None]:
    """Kind of each text, None for real content; null and blank texts are real (they are not residue)."""
    out: list[str | None] = [None] * len(texts)
    shown = [(i, s) for i, s in ((i, visible(t)) for i, t in enumerate(texts) if t) if s]
    if not shown:
        return out
    f = features([s for _, s in shown])
    piece, page = model.piece.chances(f.bucket, f.at), model.page.chances(*f.pages)
    best = np.zeros((len(shown), len(KINDS)))
    np.maximum.at(best, f.doc, piece)
    for (i, _), inside, whole in zip(shown, best, page):
        k = 1 + int(np.argmax(whole[1:]))
        if whole[k] < (PAGE_SURE if k > 2 else PIECE_SURE):
            k = 1 + int(np.argmax(inside[1:3]))
            if inside[k] < PIECE_SURE:
                continue
        out[i] = KINDS[k]
    return out


# --- the operator ------------------------------------------------------------------


def host(documents: DataFrame) -> Column:
    """Host of a document: the owner of its repository, else its source."""
    owner = F.regexp_extract(F.lower(F.coalesce(F.col("repo_id"), F.lit(""))), r"([^/:@\s]+)/[^/]+/?\s*$", 1)
    return F.when(owner != "", owner).otherwise(F.coalesce(F.lower(F.trim("source")), F.lit("unknown")))


def _unseen(documents: DataFrame) -> Column:
    return F.pmod(F.xxhash64(host(documents)), F.lit(HELD_OUT)) == 0


def sample(documents: DataFrame, docs: int = SAMPLE_DOCS, seed: int = 3407) -> list[str]:
    """About ``docs`` different texts to train on, by a cut of their seeded hashes, from hosts that are not held out.

    The cut follows from the number of different texts, so only the sample
    leaves the tasks; a text that a third of all rows repeat counts once.
    """
    hashed = documents.where(F.col("text").isNotNull() & ~_unseen(documents)).select(F.xxhash64(F.lit(seed), "text").alias("h"), "text")
    many = hashed.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    cut = -(1 << 63) + int((1 << 64) * min(1.0, docs / max(many, 1))) - 1
    rows = hashed.where(F.col("h") <= min(cut, (1 << 63) - 1)).dropDuplicates(["h"]).collect()  # about ``docs`` rows
    return [r["text"] for r in sorted(rows, key=lambda r: r["h"])]


def train(documents: DataFrame, docs: int = SAMPLE_DOCS) -> Residue:
    """Classifiers fitted on a bounded sample of ``docs`` documents."""
    return fit(sample(documents, docs))


def residue(documents: DataFrame, model: Residue) -> DataFrame:
    """``doc_id, kind`` of every document that is residue instead of content.

    Each text is judged whole, where it is scanned; nothing is shuffled.  Null
    or blank texts are no residue; rows without ``doc_id`` cannot be named;
    repeated rows are each judged.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # fixed size: kinds x BUCKETS

    @F.arrow_udf("string")
    def kinds(col: pa.Array) -> pa.Array:
        texts = col.to_pylist()
        return pa.array([k for at in range(0, len(texts), DOCS_AT_ONCE) for k in judge(shared.value, texts[at : at + DOCS_AT_ONCE])], pa.string())

    judged = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), kinds("text").alias("kind"))
    return judged.where("kind is not null")


def validation(documents: DataFrame, docs: int = SAMPLE_DOCS) -> DataFrame:
    """``held_out, label, kind, docs``: what :func:`judge` says of documents of hosts unseen in training, beside their weak labels.

    ``held_out`` is ``hosts`` for the very classifiers that judge, and ``hosts and
    phrases`` for classifiers trained without a quarter of the phrase families
    in turn, counted over the documents that only those families label.
    """
    texts = sample(documents, docs)
    models = [fit(texts, without=f) for f in (None, *range(FOLDS))]
    shared = documents.sparkSession.sparkContext.broadcast(models)

    def compare(batches):
        names = ["held_out", "label", "kind", "docs"]
        for b in batches:
            n: dict[tuple, int] = {}
            all_texts = b.column(0).to_pylist()
            for at in range(0, len(all_texts), DOCS_AT_ONCE):
                part = all_texts[at : at + DOCS_AT_ONCE]
                said = [judge(m, part) for m in shared.value]
                for i, text in enumerate(part):
                    label, families, _ = labels(visible(text))
                    if label < 0:
                        continue
                    rows = [("hosts", said[0][i])]
                    folds = {(k + f) % FOLDS for k, f in families}
                    if len(folds) == 1:
                        rows.append(("hosts and phrases", said[1 + folds.pop()][i]))
                    for scope, kind in rows:
                        key = scope, KINDS[label], kind or "none"
                        n[key] = n.get(key, 0) + 1
            yield pa.record_batch([*(pa.array([k[i] for k in n], pa.string()) for i in range(3)), pa.array(list(n.values()), pa.int64())], names=names)

    unseen = documents.where(F.col("text").isNotNull() & _unseen(documents)).select("text")
    return unseen.mapInArrow(compare, "held_out string, label string, kind string, docs long").groupBy("held_out", "label", "kind").agg(F.sum("docs").alias("docs"))
