"""A semi-Markov conditional random field for personal items in free text, in numpy.

A labelling of a text is a sequence of segments: candidate spans that carry a type, and
single tokens outside of all of them. A segment's score is the weighted sum of features of
the whole span (its shape, its words, what stands before and after it). The best labelling
is found by dynamic programming over segment ends. Weights are trained by maximising the
conditional likelihood, whose normaliser comes from the same recursion.

Many texts are laid end to end in one *page*, with a separator between them that no segment
crosses. The page is cut into tokens once; a token has a category, so features name
categories of words (titles, labels such as "passport", verbs of saying), never the words.
Features are integers, and the scores of all candidates of a page are one gather and sum.

Segments are of bounded length, as the method asks: ``NAME_UNITS`` words of a name,
``ID_CHUNKS`` groups of an identity number, ``ADDRESS_LEFT`` and ``ADDRESS_RIGHT`` tokens
before and after a street word. A longer item can't be found as one.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

KINDS = ("email", "phone", "id_number", "address", "name")
SEPARATOR = "\x00"
NAME_UNITS = 8
ID_CHUNKS = 6
ADDRESS_LEFT, ADDRESS_RIGHT = 9, 16
#: Tokens before and after a candidate in which a label is looked for.
LABEL_LEFT, LABEL_RIGHT = 6, 4
#: Blanks looked over between a local part and a bracketed at sign.
BLANKS = 16
#: Distinct words whose category a worker remembers before it starts anew.
REMEMBERED = 200_000

# Categories of words, chosen for this model from general English, German, French and Spanish.
LEXICON = {
    "particle": "von der den van de la le al el bin bint ibn di da du del dos ter zu y",
    "title": "dr mr mrs ms miss prof professor sir madam herr frau monsieur madame mme mlle señor señora sr sra doña doktor",
    "org": (
        "gmbh inc ltd llc corp corporation company co ag sa plc kg team group crew labs lab response security research foundation institute university agency college hospital "
        "project community collective office consulting systems software technologies networks solutions services partners department ministry bank press union council society "
        "association committee authority centre center clinic school library museum logistics industries holdings studio studios club alliance network"
    ),
    "street": "street st avenue ave road rd lane ln terrace close drive court ct square sq way boulevard blvd place pl row crescent grove hill gardens mews parade",
    "head": "rue avenue boulevard calle avenida via allée place chemin plaza camino quai impasse paseo",
    "tail": "straße strasse weg gasse allee platz ufer damm ring",
    "box": "box postfach apartado",
    "flat": "flat apt apartment unit suite room floor",
    "joiner": "de des du la le les del los las der am an bis ter im d",
    "id": (
        "ssn passport passports id ids identity nin nino identification identifier taxpayer tax insurance social licence license permit citizen resident residence personal personnummer national civil driver "
        "ausweis ausweisnummer personalausweis steuernummer steuer reisepass pass dni nif nie passeport pasaporte identité identidad fiscal cpr card cedula"
    ),
    "phone": "phone telephone tel telefon téléphone teléfono mobile cell call calls called ring rang dial hotline handy fax sms text texted móvil portable whatsapp reachable callback number reach anrufen",
    "mail": "mail email e-mail contact write wrote mailto correo courriel kontakt cc bcc forward forwarded inbox schreiben écrire",
    "place": "address lives live lived living resides home house office located moved ship shipped deliver delivered send sent visit letters parcel postal wohnt adresse anschrift dirección domicilio habite vive meet collect based",
    "cue": (
        "by author authors maintainer maintainers owner owners reporter contributor contributors colleague colleagues thanks thank credit credits dear hi hello hey name named called signed sincerely regards cheers meet met ask asked tell told "
        "patient employee tenant applicant customer guest student teacher developer developers engineer manager member nurse driver witness sender recipient attendee with from according per danke merci gracias bonjour hallo hola liebe lieber "
        "employees customers holder friend neighbour ansprechpartner interlocuteur"
    ),
    "say": (
        "said says wrote writes reported reports found finds noticed discovered confirmed confirms asked asks lives lived called calls sent sends joined left works worked signed fixed pushed merged opened closed reviewed approved "
        "told tells and who whose is was has had will can would agreed paid ordered booked bought schrieb sagte hat a dit dijo maintains maintained owns owned published resigned arrived phoned"
    ),
    "ref": (
        "ticket issue order invoice build release version versions commit port ports line lines offset offsets offset cve ghsa checksum hash sha revision rev page pages chapter serial sku part model batch room gate flight track error code "
        "year date day dated released published updated on since until before after at between patch range ref reference case bug pr tag ip host node timestamp seq sequence size bytes digest fingerprint key uuid row rows column columns"
    ),
    "unit": "ms s sec seconds minutes hours days bytes byte kb mb gb kib mib times downloads installs files lines rows users percent euros dollars usd eur items tests records stars tokens requests pixels px",
    "function": (
        "the a an and or of in on to for from by with at as is are was were be been it its this that these those my your our their his her no not new old all some any each every one two three if when where while who whose which why how what "
        "after before until since but so then there here please note see also only just more most many much very we you they he she i us them him both either neither nor yes ok has have had do does did can could will would should may might must "
        "der die das ein eine ist sind und oder nicht mit von für auf bei wir sie er es le les un une des est sont et ou pas avec pour sur nous vous il elle el los las una es son y o no con por para en"
    ),
    "common": (
        "abuse access account accounts action android apache arbitrary address admin advisory affected agreement alert analysis appendix application archive article attack authentication author backup bad basic best beta branch browser bug build bundle call change changes channel chapter "
        "check class clean client cloud code command commit common configuration console consumption contact content credit critical cross customer data database date default delete denial dependency deployment description desktop details device directory "
        "document documentation domain download edition email engine entry environment error event example exploit export expression feature field file files final first fix folder form format framework free full function general good guide "
        "handler hash head header help high history home hook host hotfix image impact import improper in index information injection input install installation instance integration interface internal internet internship invoice issue item job kernel key language latest launch "
        "layer leak letter level library licence license line link linux list local log login loader low mail main maintainer malicious malware manager manual map master medium meeting memory menu message method middle migration mirror misc mobile mode model module monitor name nations "
        "network node note notes notice number object offset online open operating option order output overflow overview owner package packages page parameter parser part password patch path payload permission phone platform plugin policy pollution pool port position post prefix private problem "
        "process product profile program protocol prototype proxy public publisher query question quick range read readme record records reference region registry regular release remote report repository request reset resource response robot result return review right risk role root route rule run runtime "
        "sample schema scope screen script scripting search second section secure self send serial server service session set setting settings setup severity share shell short signature site size small software solution source space spec sql stack staging standard start state status step storage store stream string style "
        "subject submit suite summary support switch symbol syntax system table tag target task template test tests text theft theme thread ticket time title token tool tools top total tracker traffic transfer traversal tree trigger trust type uncontrolled uninstall union unit united update upgrade upload usage use user users utility validation value vendor verify version versions "
        "view virtual virus visual volume vulnerability warning watch web website weekly welcome widget window windows workaround world wall workflow workspace write zone north south east west upper lower great royal monday tuesday wednesday thursday friday saturday sunday january february march april june july august september october november december"
    ),
}
#: Words of other categories that are names, too, where a capital begins them.
NAME_WORDS = frozenset("an le la du al ping my de van".split())
ROLES = frozenset(
    (
        "abuse admin administrator billing bot bugs ci contact cert csirt dev devnull dev-null do-not-reply donotreply enquiries feedback ftp git help helpdesk hello hg hostmaster "
        "info infosec issues it jobs legal list mail mailer-daemon maintainers marketing media news newsletter no-reply nobody noc noreply notifications npm office ops "
        "postmaster press privacy psirt registry release report root sales security service services soc spam staff support svn sysadmin team test webmaster www"
    ).split()
)

BIT = {name: 1 << k for k, name in enumerate(LEXICON)}
CAPITAL, CAPS, LONE, CASELESS, NAMEWORD = (1 << (len(LEXICON) + k) for k in range(5))
WORD_BITS: dict[str, int] = {}
for _name, _words in LEXICON.items():
    for _w in _words.split():
        WORD_BITS[_w] = WORD_BITS.get(_w, 0) | BIT[_name]
TAILS = tuple(LEXICON["tail"].split())

# token categories, as contexts see them
PUNCTUATION = ",.:;()<>\"'-/@#=_[]*!?&%+|~"
C_NONE, C_LOWER, C_CAPITAL, C_CAPS, C_NUMBER, C_SIGN, C_FIRST_SIGN = range(7)
C_LEXICON = C_FIRST_SIGN + len(PUNCTUATION)
#: Order in which the categories of a word of several claim it.
CLAIMS = ("id", "phone", "mail", "cue", "place", "title", "say", "ref", "unit", "org", "function", "particle")
N_CATEGORIES = C_LEXICON + len(CLAIMS)
GAP_NONE, GAP_BLANK, GAP_LINE, GAP_BREAK = range(4)

LETTER, DIGIT, SPACE, OTHER = 1, 2, 3, 0
UNIT_KINDS = ("plain", "title", "org", "street", "function", "particle", "initial", "common", "caseless", "nameword", "label")
J_BLANK, J_HYPHEN, J_COMMA, J_LINE, J_DOT = range(1, 6)


@lru_cache(maxsize=1)
def character_tables() -> tuple[np.ndarray, np.ndarray]:
    """(class, case) of every code point: letters and combining marks, digits, white space, other; case 1 small, 2 capital, 3 none."""
    kind, case = np.zeros(0x110000, dtype=np.uint8), np.zeros(0x110000, dtype=np.uint8)
    names = [unicodedata.category(chr(c)) for c in range(0x110000)]
    first = np.array([ord(n[0]) for n in names], dtype=np.uint8)
    kind[(first == ord("L")) | (first == ord("M"))] = LETTER
    kind[np.array([n == "Nd" for n in names])] = DIGIT
    kind[[c for c in range(0x3001) if chr(c).isspace()]] = SPACE
    case[np.array([n in ("Lu", "Lt") for n in names])] = 2
    case[np.array([n == "Ll" for n in names])] = 1
    case[(first == ord("L")) & (case == 0)] = 3
    kind[[0xAA, 0xBA]] = OTHER  # ordinal signs
    return kind, case


def word_bits(word: str, case: int) -> int:
    """Categories and spelling of a word. ``case`` is that of its first character."""
    low = word.lower()
    if "'" in low or "’" in low:
        low = re.sub(r"^.{1,2}['’]", "", low)
    bits = WORD_BITS.get(low, 0)
    if len(low) > 4 and low.endswith(TAILS):
        bits |= BIT["tail"]
    if case == 2:
        bits |= CAPITAL
        if len(word) > 1 and word.isupper():
            bits |= CAPS
        if low in NAME_WORDS:
            bits |= NAMEWORD
    elif case == 3:
        bits |= CAPITAL | CASELESS
    return bits | (LONE if len(word) == 1 else 0)


def category_of(bits: int) -> int:
    for k, name in enumerate(CLAIMS):
        if bits & BIT[name]:
            return C_LEXICON + k
    return C_CAPS if bits & CAPS else C_CAPITAL if bits & CAPITAL else C_LOWER


def unit_kind(bits: int) -> int:
    """What a word is as a part of a name."""
    if bits & BIT["title"] and bits & CAPITAL:
        return 1
    if bits & LONE and bits & CAPITAL and not bits & CASELESS:
        return 6
    if bits & NAMEWORD:
        return 9
    if bits & BIT["org"]:
        return 2
    if bits & BIT["particle"]:
        return 5
    if bits & (BIT["street"] | BIT["head"] | BIT["box"] | BIT["flat"]):
        return 3
    if bits & (BIT["function"]):
        return 4
    if bits & (BIT["id"] | BIT["phone"] | BIT["mail"] | BIT["cue"] | BIT["place"] | BIT["say"] | BIT["ref"] | BIT["unit"]):
        return 10
    if bits & BIT["common"]:
        return 7
    return 8 if bits & CASELESS else 0


_NUMBERS: dict[str, int] = {}
_TABLE: list[tuple[int, int, int]] = []


def known_words(words: list[str], cases: np.ndarray) -> np.ndarray:
    """(bits, category, unit kind) of each word, looked up once per distinct word."""
    if len(_TABLE) > REMEMBERED:
        _NUMBERS.clear(), _TABLE.clear()
    number = np.fromiter((_NUMBERS.get(w, -1) for w in words), dtype=np.int64, count=len(words))
    for k in np.flatnonzero(number < 0).tolist():
        w = words[k]
        if w not in _NUMBERS:
            bits = word_bits(w, int(cases[k]))
            _NUMBERS[w] = len(_TABLE)
            _TABLE.append((bits, category_of(bits), unit_kind(bits)))
        number[k] = _NUMBERS[w]
    distinct, place = np.unique(number, return_inverse=True)
    return np.array([_TABLE[k] for k in distinct.tolist()], dtype=np.int64).reshape(-1, 3)[place]


_SIGNS = np.full(0x110000, C_SIGN, dtype=np.int64)
for _k, _c in enumerate(PUNCTUATION):
    _SIGNS[ord(_c)] = C_FIRST_SIGN + _k
_SIGNS[0] = C_NONE


class Page:
    """Texts laid end to end, their tokens and the categories of these.

    ``fields``: a number per text, 0 prose, 1 a field for names, 2 a field for contacts.
    """

    def __init__(self, texts: list[str], fields: list[int]):
        self._cache: dict[tuple[str, bool], np.ndarray] = {}
        self.text = text = SEPARATOR.join(["", *texts, ""])
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        self.begins = 1 + np.cumsum(sizes) - sizes
        self.fields = np.array([*fields, 0], dtype=np.int64)
        kinds, cases = character_tables()
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = kinds[chars].copy()
        n = len(chars)
        # an apostrophe between a letter and two letters belongs to the word
        apostrophe = np.flatnonzero(((chars == 0x27) | (chars == 0x2019))[1:-2]) + 1 if n > 3 else np.zeros(0, dtype=np.int64)
        inner = apostrophe[(kind[apostrophe - 1] == LETTER) & (kind[apostrophe + 1] == LETTER) & (kind[apostrophe + 2] == LETTER)]
        kind[inner] = LETTER
        edge = np.flatnonzero((kind[1:] != kind[:-1]) | (kind[:-1] == OTHER)) + 1
        first = np.append(0, edge)
        self.start = first[kind[first] != SPACE]
        self.end = np.append(edge, n)[kind[first] != SPACE]
        self.kind = kind[self.start]
        self.char = np.where(self.kind == OTHER, chars[self.start], 0)
        lines = np.append(0, np.cumsum(chars == 10))
        before = np.append(0, self.end[:-1])
        breaks = lines[self.start] - lines[before]
        self.gap = np.where(self.start == before, GAP_NONE, np.where(breaks == 0, GAP_BLANK, np.where(breaks == 1, GAP_LINE, GAP_BREAK)))
        self.gap_chars = self.start - before
        self.digits = np.append(0, np.cumsum(kind == DIGIT))
        self.chars, self.char_kind = chars, kind

        words = np.flatnonzero(self.kind == LETTER)
        table = known_words([text[a:b] for a, b in zip(self.start[words].tolist(), self.end[words].tolist())], cases[chars[self.start[words]]])
        size = len(self.start)
        self.bits, self.unit = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        self.category = np.where(self.kind == DIGIT, C_NUMBER, _SIGNS[chars[self.start]])
        self.bits[words], self.category[words], self.unit[words] = table[:, 0], table[:, 1], table[:, 2]
        self.separator = np.flatnonzero((self.kind == OTHER) & (chars[self.start] == 0))

    def near(self, name: str, at: np.ndarray, left: bool) -> np.ndarray:
        """Whether a word of the category is among the tokens just before (after) the token ``at``, in the same text."""
        last, wall = self._nearest(name, left), self._nearest("", left)
        if left:
            p = at - 1
            return (last[p] > wall[p]) & (p - last[p] < LABEL_LEFT)
        p = np.minimum(at, len(self.start) - 1)
        return (last[p] < wall[p]) & (last[p] - p < LABEL_RIGHT)

    def _nearest(self, name: str, left: bool) -> np.ndarray:
        """The nearest token of a category ('' for separators) at or before (after) each token."""
        if (name, left) not in self._cache:
            index = np.arange(len(self.start), dtype=np.int32)
            has = (self.bits & BIT[name]) != 0 if name else self.category == C_NONE
            self._cache[name, left] = np.maximum.accumulate(np.where(has, index, np.int32(-1))) if left else np.minimum.accumulate(np.where(has, index, np.int32(len(index)))[::-1])[::-1]
        return self._cache[name, left]


class Features:
    """Numbers of features: every template of a kind has a range of its own. 0 is no feature."""

    def __init__(self):
        self.base: dict[tuple[str, str], int] = {}
        self.size = 1

    def add(self, kind: str, template: str, size: int) -> None:
        self.base[kind, template] = self.size
        self.size += size


LEFT_LABELS = ("id", "phone", "mail", "place", "cue", "ref")
RIGHT_LABELS = ("id", "say", "unit", "phone")
PHONE_SHAPES = (
    ("plus", r"\+9[9 .()\-]*"), ("double_zero", r"009.*"), ("three_three_four", r"(?:9[ .\-])?(?:\(999\) ?|999[ .\-])999[ .\-]9999"), ("three_four", r"999-9999"), ("pairs", r"09(?:[ .\-]99){4}"),
    ("trunk", r"\(?09{1,4}\)?(?:[ /\-]9{2,5}){1,3}"), ("date", r"9{4}[.\-/]9{2}[.\-/]9{1,2}.*|9{1,2}[./]9{1,2}[./]9{4}"), ("dotted", r"9{1,3}(?:\.9{1,3}){1,3}"), ("plain", r"9+"), ("plain_zero", r"009+|09+"), ("bracket", r".*\(.*"), ("dashes", r"9+(?:-9+)+"), ("blanks", r"9+(?: 9+)+"), ("odd", r".*"),
)
ID_SHAPES = (
    ("letters_six_letter", r"AA 9{2} 9{2} 9{2} A|AA9{6}A"), ("three_two_four", r"9{3}([ \-])9{2}\1?9{4}|9{3} 9{2} 9{4}"), ("six_four", r"9{6}[\-+]9{4}"), ("letter_digits", r"A{1,2}9{6,9}"), ("digits_letter", r"9{7,8}-?A"), ("mixed", r"(?=(?:A*9){5})(?=(?:9*A){2})[A9]{8,12}"),
    ("two_threes", r"9{2} 9{3} 9{3} 9{3}"), ("plain", r"9+"), ("date", r"9{4}[\- ]9{2}[\- ]9{2}"), ("year_number", r"9{4}-9+(?:-9+)?"), ("word_number", r"A{2,}-?9.*"), ("blanks", r"9+(?: 9+)+"), ("dashes", r"9+(?:-9+)+"), ("odd", r".*"),
)
_PHONE = [re.compile(p) for _, p in PHONE_SHAPES]
_ID = [re.compile(p) for _, p in ID_SHAPES]
HEADS = tuple(
    (n, re.compile(p))
    for n, p in (
        ("number_first", r"(?:F[nmCKl]l?,)?[nmz]l?,?[CK]{1,3}S\.?"),
        ("number_head", r"[nmz]l?J?,?HJ{0,2}(?:C-?){1,3}"),
        ("number_last", r"(?:[CK]\.?-?){0,3}Tnl?(?:[\-/]nl?)?"),
        ("head_first", r"HJ{0,3}C{1,3},?[nmz]l?(?:,n\.?o[KC]?)?"),
        ("box", r"(?:K\.?K?\.?)?B[nmz]n?"),
    )
)
_POST = r"(?:(?:K-)?[mz]|K[zm]|K?,?Kz|Kl?nK?nK|KnK?nK)"
_TOWN = r"(?:S\.?)?C(?:-?J{0,2}-?C){0,2}"
ADDRESS_TAILS = tuple((n, re.compile(p)) for n, p in (("none", r""), ("town", rf",{_TOWN}"), ("town_post", rf"[,|]{{1,2}}{_TOWN},?{_POST}"), ("post_town", rf"[,|]{{1,2}}{_POST}{_TOWN}"), ("post", rf"[,|]{{1,2}}{_POST}")))
MORE = tuple((n, re.compile(p)) for n, p in (("post", r"[,|]?[mz]|[,|]?K[nz]"), ("comma_town", r",C"), ("line_town", r"\|C(?:-?C)*,?[mz]"), ("line_word", r"\|C"), ("word", r"-?C"), ("number", r"n"), ("dot", r"\."), ("comma", r",")))


def _register() -> Features:
    f = Features()
    for kind in KINDS:
        for t, n in (("bias", 1), ("l1", N_CATEGORIES), ("l2", N_CATEGORIES), ("r1", N_CATEGORIES), ("r2", N_CATEGORIES), ("gap_l", 4), ("gap_r", 4), ("field", 6), *((f"left_{x}", 2) for x in LEFT_LABELS), *((f"right_{x}", 2) for x in RIGHT_LABELS)):
            f.add(kind, t, n)
    for t, n in (("sign", 4), ("labels", 6), ("more", 2), ("dots", 2), ("prose", 2), ("role", 2), ("code", 2), ("path", 2), ("service", 2)):
        f.add("email", t, n)
    for t, n in (("digits", 18), ("shape", len(PHONE_SHAPES)), ("labelled", 3 * len(PHONE_SHAPES)), ("torn", 2)):
        f.add("phone", t, n)
    for t, n in (("shape", len(ID_SHAPES)), ("labelled", 2 * len(ID_SHAPES)), ("torn", 2), ("beside", 2), ("year", 2)):
        f.add("id_number", t, n)
    heads, tails = len(HEADS) + 1, len(ADDRESS_TAILS) + 1
    for t, n in (("head", heads), ("tail", tails), ("both", heads * tails), ("more", tails * (len(MORE) + 1)), ("before", 6), ("dot", 2)):
        f.add("address", t, n)
    kinds = len(UNIT_KINDS)
    for t, n in (
        ("size", 6 * 4), ("particle", 2), ("hyphen", 2), ("comma", 5), ("line", 2), ("org", 2), ("title", 2), ("function", 3), ("common", 3), ("street", 2), ("label", 2), ("caps", 2), ("ends_initial", 2), ("starts_particle", 2),
        ("first", kinds), ("last", kinds), ("left", kinds * 6), ("right", kinds * 6), ("possessive", 2), ("torn_left", 2), ("torn_right", 2), ("names_only", 3), ("caseless", 2), ("sentence_first", 3),
    ):
        f.add("name", t, n)
    return f


FEATURES = _register()


@dataclass
class Candidates:
    """Spans with types and the numbers of their features, 0 where a row has fewer than others."""

    kind: np.ndarray
    start: np.ndarray
    end: np.ndarray
    features: np.ndarray


def _gather(page: Page, kind: str, start: np.ndarray, end: np.ndarray, own: dict[str, np.ndarray], first=None, after=None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Own features together with those of the context."""
    if not len(start):
        return None
    first = np.searchsorted(page.start, start) if first is None else first
    after = np.searchsorted(page.start, end) if after is None else after
    top = len(page.start) - 1
    l1, r1 = page.category[first - 1], page.category[np.minimum(after, top)]
    l2 = np.where(l1 == C_NONE, C_NONE, page.category[np.maximum(first - 2, 0)])
    r2 = np.where(r1 == C_NONE, C_NONE, page.category[np.minimum(after + 1, top)])
    whole = (l1 == C_NONE) & (r1 == C_NONE)
    field = page.fields[np.searchsorted(page.begins, start, side="right") - 1]
    near = {f"left_{x}": page.near(x, first, True) for x in LEFT_LABELS} | {f"right_{x}": page.near(x, after, False) for x in RIGHT_LABELS}
    base = FEATURES.base
    if kind == "phone":
        told = np.where(near["left_phone"] | near["right_phone"], 1, np.where((field == 2) | whole, 2, 0))
        own["labelled"] = own["shape"] * 3 + told
    elif kind == "id_number":
        own["labelled"] = own["shape"] * 2 + (near["left_id"] | near["right_id"])
    context = {"bias": np.zeros(len(start), dtype=np.int64), "l1": l1, "l2": l2, "r1": r1, "r2": r2, "gap_l": page.gap[first], "gap_r": page.gap[np.minimum(after, top)], "field": field * 2 + whole, **near}
    columns = [base[kind, t] + v.astype(np.int64) for t, v in (context | own).items()]
    return np.full(len(start), KINDS.index(kind)), start, end, np.stack(columns, axis=1)


def _ahead(mask: np.ndarray, steps: int) -> np.ndarray:
    """The mask's values so many places further on, false beyond its end."""
    out = np.zeros(len(mask), dtype=bool)
    if steps < len(mask):
        out[: len(mask) - steps] = mask[steps:]
    return out


# gates

OPEN, CLOSE = re.compile(r"(?:[ \t]*[\[({<])?[ \t]*$"), re.compile(r"[ \t]*(?:[\])}>][ \t]*)?")
DOT = r"(?:\.|[ \t]*[\[({<][ \t]*(?:dot|DOT|Dot|\.)[ \t]*[\])}>][ \t]*|[ \t]+(?:dot|DOT)[ \t]+)"
#: The longest local part and the longest label of a host name.
LOCAL = re.compile(r"(?<![\w.+\-@/%])[^\W_](?:[\w.+\-]{0,62}(?:%2[Bb][\w.+\-]{0,62})?[^\W])?$")
HOST = re.compile(rf"[^\W_][\w\-]{{0,62}}((?:{DOT}[^\W\d_][\w\-]{{1,62}}){{1,5}})(?![\w\-])")
LABEL = re.compile(rf"{DOT}[^\W\d_][\w\-]{{1,62}}")
CODE_HOST = re.compile(r"\b(?:git|svn|hg|cvs|scm|vcs|bzr)\.", re.I)
SERVICE_HOST = re.compile(r"\b(?:noreply|bot|bots|notifications|users\.noreply)\b", re.I)


def _at_signs(page: Page) -> list[tuple[int, int, bool]]:
    """(start, end, written out) of every at sign: the sign, its percent code, or the word."""
    chars = page.chars
    sign = np.flatnonzero(chars == ord("@"))
    code = np.flatnonzero((chars[:-2] == ord("%")) & (chars[1:-1] == ord("4")) & (chars[2:] == ord("0")))
    word = page.start[(page.kind == LETTER) & (page.end - page.start == 2) & ((chars[page.start] | 32) == ord("a"))]
    word = word[((chars[word + 1] | 32) == ord("t")) & ~((chars[word] == ord("a")) & (chars[word + 1] == ord("T")))]
    return sorted([*((k, k + 1, False) for k in sign.tolist()), *((k, k + 3, False) for k in code.tolist()), *((k, k + 2, True) for k in word.tolist())])


def _emails(page: Page):
    text, rows, names = page.text, [], ("sign", "labels", "more", "dots", "prose", "role", "code", "path", "service")
    for left, right, worded in _at_signs(page):
        if worded or text[left - 1] in "[({< \t":  # the sign may stand in brackets or between blanks
            right = CLOSE.match(text, right).end()
            if HOST.match(text, right) is None:
                continue
            low = max(0, left - BLANKS)
            left = low + OPEN.search(text[low:left]).start()
        host = HOST.match(text, right)
        if host is None:
            continue
        sign = text[left:right]
        bracketed = any(c in "[({<" for c in sign) and any(c in "])}>" for c in sign)
        if sign not in ("@", "%40") and not bracketed and not (worded and sign[0] in " \t" and sign[-1] in " \t"):
            continue
        low = max(0, left - 140)
        local = LOCAL.search(text[low:left])
        if local is None:
            continue
        begin = low + local.start()
        shape = 0 if sign == "@" else 1 if sign == "%40" else 2 if bracketed else 3
        role = re.split(r"\+|%2b", local.group().lower())[0]
        is_role = role in ROLES or re.split(r"[.\-_]", role)[0] in ("noreply", "donotreply")
        ends = [host.start(1) + x.end() for x in LABEL.finditer(host.group(1))]
        for n, end in enumerate(ends):
            dots, where = text[host.start(1) : end], text[right:end]
            spelled = bool(re.search(r"[\[({<]|\s", dots))
            rows.append((begin, end, shape, min(n + 1, 5), n + 1 < len(ends), spelled, shape == 3 and not spelled, is_role, bool(CODE_HOST.search(where)), text[end : end + 1] == ":" and text[end + 1 : end + 2].strip() != "", bool(SERVICE_HOST.search(where))))
    table = np.array(rows, dtype=np.int64).reshape(-1, 11)
    return _gather(page, "email", table[:, 0], table[:, 1], {t: table[:, k + 2] for k, t in enumerate(names)})


PHONE = re.compile(r"(?<![\w@/.\-+])(?:\+|\(\+?)?\d(?:[  ]?[().\-/]?[  ]?\(?\d){5,}(?![\w@/])")
_DIGITS = str.maketrans("123456789 ", "999999999 ")
_ALNUM = {ord(c): "9" for c in "0123456789"} | {ord(c): "A" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {0xA0: " "}


@lru_cache(maxsize=50_000)
def _phone_shape(shape: str) -> int:
    """The first shape that fits; only leading zeros are told from other digits."""
    lead = re.match(r"\(?0{0,2}", shape).end()
    shape = shape[:lead] + shape[lead:].replace("0", "9")
    return next(k for k, p in enumerate(_PHONE) if p.fullmatch(shape))


@lru_cache(maxsize=50_000)
def _id_shape(shape: str) -> int:
    return next(k for k, p in enumerate(_ID) if p.fullmatch(shape))


def _phones(page: Page):
    spans, chars, done = [], page.chars, 0
    digit = page.char_kind == DIGIT
    runs = np.flatnonzero(digit[1:] & ~digit[:-1]) + 1
    runs -= (chars[runs - 1] == ord("+")).astype(np.int64)
    runs -= (chars[runs - 1] == ord("(")).astype(np.int64)
    # every digit of a number is at most five characters from the one before
    runs = runs[page.digits[np.minimum(runs + 32, len(chars))] - page.digits[runs] >= 6]
    for at in runs.tolist():
        if at < done or (m := PHONE.match(page.text, at)) is None:
            continue
        a, span, done = at, m.group(), m.end()
        if span[0] == "(" and ")" not in span:
            a, span = a + 1, span[1:]  # a bracket around the number
        spans.append((a, a + len(span), _phone_shape(span.translate(_DIGITS))))
        if (k := span.rfind(" ")) > 8:  # the last group may be a number of its own
            spans.append((a, a + k, _phone_shape(span[:k].translate(_DIGITS))))
    table = np.array(spans, dtype=np.int64).reshape(-1, 3)
    digits = page.digits[table[:, 1]] - page.digits[table[:, 0]]
    fits = (digits >= 6) & (digits <= 17)
    table, digits = table[fits], digits[fits]
    torn = page.chars[np.minimum(table[:, 1], len(page.chars) - 1)] == ord("-")
    return _gather(page, "phone", table[:, 0], table[:, 1], {"digits": digits, "shape": table[:, 2], "torn": torn})


def _ids(page: Page):
    """Spans of up to ``ID_CHUNKS`` groups of digits and capitals, joined by single blanks or hyphens."""
    chars = page.chars
    own = ((chars >= 48) & (chars <= 57)) | ((chars >= 65) & (chars <= 90))
    edges = np.diff(np.concatenate(([0], own.view(np.int8), [0])))
    a, b = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(a):
        return None
    padded = np.append(chars, 0)
    bad_left = np.isin(padded[a - 1], [ord(c) for c in "@/.-_"]) | ((page.char_kind[a - 1] != OTHER) & (page.char_kind[a - 1] != SPACE))
    after = np.append(page.char_kind, OTHER)[b]
    bad_right = (after == LETTER) | (after == DIGIT) | np.isin(padded[b], [ord(c) for c in "_@/"])
    glued = np.zeros(len(a), dtype=bool)
    glued[:-1] = (a[1:] - b[:-1] == 1) & np.isin(padded[b[:-1]], (32, 45, 43, 0xA0))
    follows = np.append(False, glued[:-1])
    starts = np.where(follows, padded[a - 1] != 46, ~bad_left) & ~((page.char_kind[a - 1] == LETTER) | (page.char_kind[a - 1] == DIGIT))
    found = []
    alive = starts
    for length in range(1, ID_CHUNKS + 1):
        i = np.flatnonzero(alive)
        k = i + length - 1
        digits = page.digits[b[k]] - page.digits[a[i]]
        keep = (digits >= 5) & (digits <= 14) & ~bad_right[k]
        found.append(np.stack((i[keep], k[keep])))
        alive = alive & _ahead(glued, length - 1)
    i, k = np.concatenate(found, axis=1)
    text = page.text
    shapes = np.array([_id_shape(text[x:y].translate(_ALNUM).replace(" ", " ")) for x, y in zip(a[i].tolist(), b[k].tolist())], dtype=np.int64)
    counts = page.digits[b] - page.digits[a]
    before, behind = follows[i], glued[k]
    torn = (before & (padded[a[i] - 1] == 45)) | (behind & (padded[b[k]] == 45))
    beside = (before & (counts[np.maximum(i - 1, 0)] > 0)) | (behind & (counts[np.minimum(k + 1, len(a) - 1)] > 0))
    year = ((padded[a[i]] == ord("2")) & (padded[a[i] + 1] == ord("0"))) | ((padded[a[i]] == ord("1")) & (padded[a[i] + 1] == ord("9")))
    return _gather(page, "id_number", a[i], b[k], {"shape": shapes, "torn": torn, "beside": beside, "year": year & (b[i] - a[i] == 4)})


def _names(page: Page):
    """Spans of up to ``NAME_UNITS`` capitalised words and particles, joined by a blank, hyphen, comma, single line end or stop."""
    word = page.kind == LETTER
    token = np.flatnonzero(word & (((page.bits & CAPITAL) != 0) | ((page.bits & BIT["particle"]) != 0)))
    if not len(token):
        return None
    n, top = len(token), len(page.start) - 1
    unit_of = np.full(top + 4, -1)
    unit_of[token] = np.arange(n)
    bits, kind = page.bits[token], page.unit[token]
    pad = lambda v, fill=0: np.append(v, np.full(4, fill, dtype=v.dtype))
    char, gap, gap_chars = pad(page.char), pad(page.gap, GAP_BREAK), pad(page.gap_chars, 9)
    small = (bits & CAPITAL) == 0
    dot = (char[token + 1] == 46) & (gap[token + 1] == GAP_NONE)
    with_dot = dot & ((kind == 6) | (kind == 1))
    nxt = token + 1 + with_dot
    blank = (gap[nxt] == GAP_BLANK) & (gap_chars[nxt] == 1)
    joint = np.where(unit_of[nxt] >= 0, np.where(blank, J_BLANK, np.where(gap[nxt] == GAP_LINE, J_LINE, np.where(with_dot & (gap[nxt] == GAP_NONE), J_DOT, 0))), 0)
    hyphen = (char[nxt] == 45) & (gap[nxt] == GAP_NONE) & (unit_of[nxt + 1] >= 0) & (gap[nxt + 1] == GAP_NONE)
    comma = (char[nxt] == 44) & (gap[nxt] == GAP_NONE) & (unit_of[nxt + 1] >= 0) & ((gap[nxt + 1] == GAP_LINE) | ((gap[nxt + 1] == GAP_BLANK) & (gap_chars[nxt + 1] == 1)))
    joint = np.where(hyphen, J_HYPHEN, np.where(comma, J_COMMA, joint))
    initial = kind == 6
    ends = np.where(with_dot & initial, page.end[np.minimum(token + 1, top)], page.end[token])

    spans, alive = [], ~(small & (kind != 5))
    for length in range(1, NAME_UNITS + 1):
        i = np.flatnonzero(alive)
        k = i + length - 1
        keep = ~small[k] & ~(small[i] & (length == 1))
        spans.append(np.stack((i[keep], k[keep])))
        alive = alive & _ahead(joint > 0, length - 1)
    i, k = np.concatenate(spans, axis=1)

    def total(mask: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(mask))
        return sums[high] - sums[low]

    inside = lambda mask: total(mask, i, k + 1)
    joined = lambda j: total(joint == j, i, k)
    full_unit = ~initial & (kind != 5)
    full = inside(full_unit)
    commas = joined(J_COMMA)
    next_comma = np.minimum.accumulate(np.where(joint == J_COMMA, np.arange(n), n)[::-1])[::-1]
    head_end = np.minimum(next_comma[i], k)
    head_full, head_hyphen = total(full_unit, i, head_end + 1), total(joint == J_HYPHEN, i, head_end)
    form = np.where(commas == 0, 0, np.where(commas > 1, 4, np.where(head_full <= 1, 1, np.where(head_hyphen > 0, 3, 2))))
    name_words = inside(kind == 9)
    caps = inside(((bits & CAPS) != 0) | initial | (kind == 5)) == k - i + 1
    left = np.where((i > 0) & (joint[np.maximum(i - 1, 0)] > 0), kind[np.maximum(i - 1, 0)] * 6 + joint[np.maximum(i - 1, 0)], 0)
    right_joint = np.append(joint, 0)[k]
    right = np.where(right_joint > 0, kind[np.minimum(k + 1, n - 1)] * 6 + right_joint, 0)
    first, last = token[i], token[k]
    after = last + 1 + (with_dot & initial)[k]
    category, gaps = pad(page.category, C_NONE), pad(page.gap, GAP_BREAK)
    mark = (char[after] == 0x27) | (char[after] == 0x2019)
    possessive = mark & (gaps[after] == GAP_NONE) & (gaps[after + 1] == GAP_NONE) & (page.end[np.minimum(after + 1, top)] - page.start[np.minimum(after + 1, top)] == 1) & (pad(page.kind)[after + 1] == LETTER)
    tight = np.array([_SIGNS[ord(c)] for c in "-/@#=_.'&%+~"] + [C_NUMBER, C_LOWER, C_CAPITAL, C_CAPS])
    before = page.category[first - 1]
    torn_left = (page.gap[first] == GAP_NONE) & (np.isin(before, tight) | (before >= C_LEXICON)) & (left == 0)
    tight_right = np.array([_SIGNS[ord(c)] for c in "-/@_"] + [C_NUMBER, C_LOWER, C_CAPITAL, C_CAPS])
    torn_right = (gaps[after] == GAP_NONE) & (np.isin(category[after], tight_right) | (category[after] >= C_LEXICON)) & (right == 0) & (gaps[after + 1] != GAP_BLANK)
    opens = np.where(before == C_NONE, 1, np.where(np.isin(before, [_SIGNS[ord(c)] for c in ".!?"]), 2, 0))
    function = inside(kind == 4)
    common = inside(kind == 7)
    own = {
        "size": np.minimum(full, 5) * 4 + np.minimum(inside(initial), 3), "particle": inside(small) > 0, "hyphen": joined(J_HYPHEN) > 0, "comma": form, "line": joined(J_LINE) > 0, "org": inside(kind == 2) > 0, "title": inside(kind == 1) > 0,
        "function": np.minimum(function, 2), "common": np.minimum(common, 2), "street": inside(kind == 3) > 0, "label": inside(kind == 10) > 0, "caps": caps & (full > 0), "ends_initial": initial[k], "starts_particle": small[i],
        "first": kind[i], "last": kind[k], "left": left, "right": right, "possessive": possessive, "torn_left": torn_left, "torn_right": torn_right, "names_only": np.where(name_words == 0, 0, np.where(name_words == full, np.where(i == k, 2, 1), 1)), "caseless": inside(kind == 8) > 0, "sentence_first": opens,
    }
    return _gather(page, "name", page.start[first], ends[k], own, first, after)


#: What a token is in an address, by the first of its categories.
_ADDRESS_WORD = (("box", "B"), ("flat", "F"), ("street", "S"), ("head", "H"), ("tail", "T"))
_ALLOWED_SIGNS = {ord(","): ",", ord("."): ".", ord("-"): "-", ord("/"): "/", 0xBA: "o", 0xAA: "o", 0xB0: "o"}


def _address_letters(page: Page, at: np.ndarray) -> list[str]:
    """A letter per token; '' where no address can go on."""
    out = []
    for kind, char, bits, size, gap in zip(page.kind[at].tolist(), page.char[at].tolist(), page.bits[at].tolist(), (page.end - page.start)[at].tolist(), page.gap[at].tolist()):
        if kind == DIGIT:
            out.append("n" if size < 4 else "m" if size == 4 else "z" if size < 7 else "")
        elif kind == OTHER:
            out.append(_ALLOWED_SIGNS.get(char, ""))
        elif bits & LONE and gap == GAP_NONE and not bits & CAPITAL:
            out.append("l")
        elif bits & CAPITAL and not bits & CASELESS:
            of = next((c for name, c in _ADDRESS_WORD if bits & BIT[name]), None)
            out.append(of or ("K" if size < 4 and bits & (CAPS | LONE) else "C"))
        elif bits & BIT["head"]:
            out.append("H")
        elif bits & BIT["tail"]:
            out.append("T")
        else:
            out.append("J" if bits & BIT["joiner"] else "")
    return out


@lru_cache(maxsize=50_000)
def _address_spans(before: str, anchor: str, after: str) -> tuple[tuple[int, int, int, int, int, int, int], ...]:
    """Spans around an anchor, counted in letters: (letters before it, letters after it, head, tail, more, before, dot)."""
    out = []
    for i in range(len(before), -1, -1):
        if (before[i:] + anchor)[0] not in "nmzCHFBSTK":
            continue
        for k in range(len(after) + 1):
            span = before[i:] + anchor + after[:k]
            if span[-1] not in "nmzClSTKo." or span[-1] == "." and span[-2:-1] not in ("S", "o"):
                continue
            head = tail = 0
            for h, (_, p) in enumerate(HEADS, 1):
                if (m := p.match(span)) is not None:
                    fits = next((t for t, (_, q) in enumerate(ADDRESS_TAILS, 1) if q.fullmatch(span[m.end() :])), 0)
                    if fits or not head:
                        head, tail = h, fits
                    if fits:
                        break
            more = next((x for x, (_, p) in enumerate(MORE, 1) if p.match(after[k:])), 0)
            left = before[:i][-1:]
            out.append((len(before) - i, k, head, tail, more, " nCF,".find(left) if left and left in "nCF," else 5 if left else 0, int(span[-1] == "S" and after[k : k + 1] == ".")))
    return tuple(out)


def _addresses(page: Page):
    anchor_bits = BIT["street"] | BIT["head"] | BIT["tail"] | BIT["box"]
    bits = page.bits
    anchors = np.flatnonzero(((bits & anchor_bits) != 0) & (((bits & CAPITAL) != 0) | ((bits & BIT["head"]) != 0)))
    if not len(anchors):
        return None
    top, rows, seen = len(page.start) - 1, [], set()
    numbers = np.append(0, np.cumsum(page.kind == DIGIT))
    # an address has a number; anchors without one in reach are no use
    low, high = np.maximum(anchors - ADDRESS_LEFT, 0), np.minimum(anchors + ADDRESS_RIGHT + 1, top)
    for at, a, b in zip(*(x[numbers[high] > numbers[low]].tolist() for x in (anchors, low, high))):
        around = np.arange(a, b)
        letters, gaps = _address_letters(page, around), page.gap[around].tolist()
        mid = at - a
        before, places = "", []
        for j in range(mid - 1, -1, -1):
            if gaps[j + 1] == GAP_BREAK or not letters[j]:
                break
            before = letters[j] + ("|" if gaps[j + 1] == GAP_LINE else "") + before
            places = [j, *([j] if gaps[j + 1] == GAP_LINE else []), *places]
        after, tokens = "", []
        for j in range(mid + 1, len(letters)):
            if gaps[j] == GAP_BREAK or not letters[j]:
                break
            after += ("|" if gaps[j] == GAP_LINE else "") + letters[j]
            tokens += [*([j] if gaps[j] == GAP_LINE else []), j]
        for left, right, *features in _address_spans(before, letters[mid], after):
            first = places[len(before) - left] if left else mid
            last = tokens[right - 1] if right else mid
            if (a + first, a + last) not in seen:
                seen.add((a + first, a + last))
                rows.append((a + first, a + last, *features))
    table = np.array(rows, dtype=np.int64).reshape(-1, 7)
    head, tail, more, before, dot = table[:, 2:].T
    tails = len(ADDRESS_TAILS) + 1
    own = {"head": head, "tail": tail, "both": head * tails + tail, "more": tail * (len(MORE) + 1) + more, "before": before, "dot": dot}
    return _gather(page, "address", page.start[table[:, 0]], page.end[table[:, 1]], own, table[:, 0], table[:, 1] + 1)


def propose(page: Page) -> Candidates:
    """All candidate segments of a page."""
    parts = [p for p in (_emails(page), _phones(page), _ids(page), _addresses(page), _names(page)) if p is not None]
    width = max((p[3].shape[1] for p in parts), default=1)
    joined = np.zeros((sum(len(p[0]) for p in parts), width), dtype=np.int64)
    at = 0
    for *_, f in parts:
        joined[at : at + len(f), : f.shape[1]] = f
        at += len(f)
    column = lambda k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, dtype=np.int64)
    return Candidates(column(0), column(1), column(2), joined)


class SemiCRF:
    """Weights by feature, inference and training."""

    def __init__(self, weights: np.ndarray | None = None):
        self.weights = np.zeros(FEATURES.size) if weights is None else weights

    def scores(self, c: Candidates) -> np.ndarray:
        return self.weights[c.features].sum(axis=1)

    def best(self, c: Candidates) -> list[tuple[int, int, int]]:
        """(start, end, kind) of the labelling of the highest score. Between segments lie tokens outside, which score 0."""
        return best_segments(c.start, c.end, c.kind, self.scores(c))

    def train(self, samples: list[tuple[str, int, set[tuple[str, int, int]]]], rounds: int = 8, rate: float = 0.25, shrink: float = 1e-3, batch: int = 40, seed: int = 7) -> None:
        """Gradient ascent on the conditional log-likelihood of (text, field, labelled spans), in batches, with adaptive rates and an L2 penalty."""
        order = np.random.default_rng(seed)
        squares = np.full(len(self.weights), 1e-3)
        pages = []
        for a in range(0, len(samples), batch):
            part = samples[a : a + batch]
            page = Page([t for t, _, _ in part], [f for _, f, _ in part])
            gold = {(KINDS.index(k), x + b, y + b) for (_, _, spans), b in zip(part, page.begins.tolist()) for k, x, y in spans}
            c = propose(page)
            told = np.array([s in gold for s in zip(c.kind.tolist(), c.start.tolist(), c.end.tolist())], dtype=float)
            pages.append((c, told))
        for _ in range(rounds):
            for p in order.permutation(len(pages)).tolist():
                c, told = pages[p]
                wanted = told - expectations(c.start, c.end, self.scores(c))[0]
                gradient = np.bincount(c.features.ravel(), weights=np.repeat(wanted, c.features.shape[1]), minlength=len(self.weights))
                gradient -= shrink * len(told) * self.weights / 10
                gradient[0] = 0.0
                squares += gradient * gradient
                self.weights += rate * gradient / np.sqrt(squares)


def best_segments(start: np.ndarray, end: np.ndarray, kind: np.ndarray, score: np.ndarray) -> list[tuple[int, int, int]]:
    """The choice of disjoint segments with the highest sum of scores."""
    live = np.flatnonzero(score > 0)  # others can't be in the best one
    live = live[np.argsort(end[live], kind="stable")]
    ends, value, chosen = [0], [0.0], [None]  # best labelling up to an end; between two ends nothing changes
    for a, b, t, s in zip(start[live].tolist(), end[live].tolist(), kind[live].tolist(), score[live].tolist()):
        lo, hi = 0, len(ends)
        if ends[-1] <= a:
            lo = hi - 1
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if ends[mid] <= a else (lo, mid)
        if value[lo] + s > value[-1] + 1e-12:
            ends.append(b), value.append(value[lo] + s), chosen.append((a, b, t, lo))
    out, k = [], len(ends) - 1
    while chosen[k] is not None:
        a, b, t, k = chosen[k]
        out.append((a, b, t))
    return out[::-1]


def expectations(start: np.ndarray, end: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, float]:
    """Each candidate's probability, and the logarithm of the normaliser, by the forward and backward recursions."""
    if not len(start):
        return np.zeros(0), 0.0
    points = np.unique(np.concatenate(([0], start, end)))
    a, b = np.searchsorted(points, start).tolist(), np.searchsorted(points, end).tolist()
    s, n = score.tolist(), len(points)
    into: list[list[int]] = [[] for _ in range(n)]
    out: list[list[int]] = [[] for _ in range(n)]
    for k, (x, y) in enumerate(zip(a, b)):
        into[y].append(k)
        out[x].append(k)
    forward, backward = [0.0] * n, [0.0] * n
    for p in range(1, n):
        forward[p] = _log_sum([forward[p - 1], *(forward[a[k]] + s[k] for k in into[p])]) if into[p] else forward[p - 1]
    for p in range(n - 2, -1, -1):
        backward[p] = _log_sum([backward[p + 1], *(backward[b[k]] + s[k] for k in out[p])]) if out[p] else backward[p + 1]
    f, g = np.array(forward), np.array(backward)
    return np.exp(np.minimum(0.0, f[a] + score + g[b] - forward[-1])), forward[-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))
