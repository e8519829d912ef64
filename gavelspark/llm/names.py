"""Names of people and committees as typed: parsing, and the cost of reading one as a given person.

Plain Python, used inside Arrow batches on distinct spellings only.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import lru_cache

#: Entries of a worker's caches; several workers share an executor's memory.
KEPT = 50_000

# Titles, generational suffixes, words of committee names that carry no topic.
TITLES = frozenset("the hon honorable mr mrs ms miss dr rep representative sen senator assemblymember member".split())
SUFFIXES = frozenset("jr sr ii iii iv".split())
BODY_WORDS = frozenset("committee committees cmte ctte comm comte com standing select joint on the of for and".split())
#: A text with one of these is no person's name.
BODY = r"\b(committees?|cmte|ctte|comm|comte|joint|standing|select)\b|&"
NOBODY = frozenset("tbd none unknown na nobody various anonymous illegible vacant staff attached unnamed pending redacted blank missing withheld unsigned".split())
#: Phrases in place of a name.
NOBODY_TEXT = re.compile(r"by request|see attached|several|members? of|on file|not (?:given|stated|known)|no name|withdrawn|\bet al\b|^\W*n\W*a\W*$", re.I)

# Usual short forms of first names (public knowledge).
SHORT_FORMS = {
    "abigail": "abby abbie gail", "alexander": "alex sandy al xander", "anthony": "tony ant", "bartholomew": "bart",
    "benjamin": "ben benny benji", "charles": "chuck charlie chas charley", "christopher": "chris kit topher", "cynthia": "cindy cyndy cyndi",
    "deborah": "deb debbie debby", "dorothy": "dot dottie dolly", "edward": "ed eddie ned ted teddy", "eleanor": "ellie nell nora ella",
    "elizabeth": "betty liz beth lizzie eliza bess betsy libby", "frances": "fran frankie fanny", "francisco": "frank paco pancho cisco", "frederick": "fred fritz freddie freddy",
    "gerald": "jerry gerry", "gilbert": "gil bert", "guadalupe": "lupe lupita", "harold": "hal harry", "herbert": "herb bert herbie",
    "ignacio": "nacho iggy", "jacqueline": "jackie jacqui", "jose": "pepe joe", "josephine": "jo josie", "katherine": "kate katie kathy kat kit kathie",
    "lawrence": "larry lars laurie", "leonard": "len lenny leo", "margaret": "meg maggie peg peggy marge", "michael": "mike mick mickey", "montgomery": "monty",
    "nathaniel": "nate nat nathan", "pamela": "pam", "patricia": "pat patty tricia trish patti", "rebecca": "becky becca", "richard": "rich rick dick ricky",
    "robert": "rob bob bobby robbie bert", "rosalind": "roz rosie", "samuel": "sam sammy", "susan": "sue susie suzy", "theodore": "ted theo teddy",
    "tobias": "toby", "valentina": "val tina", "victoria": "tori vicky vickie", "william": "will bill billy willie liam", "winifred": "winnie freddie fred",
    "zachary": "zach zack zak", "thomas": "tom tommy", "james": "jim jimmy jamie", "john": "jack johnny", "joseph": "joe joey", "andrew": "andy drew",
    "daniel": "dan danny", "david": "dave", "stephen": "steve", "steven": "steve", "timothy": "tim", "matthew": "matt", "gregory": "greg", "jeffrey": "jeff",
    "kenneth": "ken kenny", "ronald": "ron", "donald": "don", "douglas": "doug", "peter": "pete", "philip": "phil", "raymond": "ray", "catherine": "cathy kate cat",
    "barbara": "barb", "jennifer": "jen jenny", "kimberly": "kim", "sandra": "sandy", "virginia": "ginny", "walter": "walt", "henry": "hank harry", "albert": "al bert",
}
SHORT = {k: frozenset(v.split()) for k, v in SHORT_FORMS.items()}


def repair(text: str) -> str:
    """UTF-8 that was read as Windows-1252 or Latin-1, read rightly; else unchanged."""
    if not re.search("[ÃÂâÅÄ]", text):
        return text
    text = re.sub("[âÂ]€[™˜]", "’", text)
    text = re.sub("[âÂ]€[“”œ\x9d\x93\x94]", "-", text)

    def fix(m: re.Match) -> str:
        for code in ("cp1252", "latin-1"):
            try:
                return m[0].encode(code).decode("utf-8")
            except UnicodeError:
                continue
        return m[0]

    return re.sub("[ÃÂÅÄ][\x80-\xbfŒ-™]", fix, text)


def fold(text: str) -> str:
    """Case and accents removed."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))


@dataclass
class Name:
    """A typed name: folded word tokens in reading order, nicknames in brackets, suffix, district."""

    tokens: list[str] = field(default_factory=list)
    nick: list[str] = field(default_factory=list)
    suffix: str = ""
    district: int | None = None
    joined: frozenset[str] = frozenset()  # further readings of neighbouring words, from key sets


_QUOTED = re.compile(r"[(\[\"“”«]([^)\]\"“”»]*)[)\]\"“”»]")


@lru_cache(maxsize=KEPT)
def parse(text: str | None) -> Name:
    """Reads a typed name.  Null, empty and meaningless texts give a name without tokens."""
    out = Name()
    if not text:
        return out
    text = repair(text)

    def bracket(m: re.Match) -> str:
        inner = fold(m[1])
        if d := re.search(r"\b(?:[a-z]{1,3}[- ]*|ld[- ]*|district[- ]*)(\d{1,3})\b", inner):
            out.district = int(d[1])
        elif words := re.findall(r"[a-z0-9]+", inner):
            out.nick.append(words[0])
        return " "

    text = re.sub(_QUOTED, bracket, text)
    text = fold(text).replace("’", "'").replace("`", "'").replace("ʼ", "'")
    text = re.sub(r"(?<=\w)'(?=\w)", "", text)
    text = re.sub(r"[‐-―−]", "-", text)
    head, _, tail = text.partition(",")
    words = []
    for part in (tail, head) if words_of(tail) and any(w not in SUFFIXES for w in words_of(tail)) else (head, tail):
        words += words_of(part)
    # "Last, Jr., First" has its first name after the second comma; suffixes are taken out anyway.
    for w in words:
        if w in SUFFIXES:
            out.suffix = w
        elif w not in TITLES:
            out.tokens.append("st" if w == "saint" else w)
    if not out.tokens and words and all(w in TITLES for w in words):
        return Name()
    return out


def words_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.replace("-", " "))


def parse_keys(keys) -> Name:
    """A set of folded words and joins of neighbouring words.  The shortest keys that no
    other keys make up count as words, in no order; the rest stay as joined readings."""
    have = sorted({fold(k) for k in keys if k}, key=len) if keys is not None else []
    words: list[str] = []
    for k in have:
        if not _made_of(k, frozenset(words)):
            words.append(k)
    out = Name(joined=frozenset(have))
    for w in words:
        if w in SUFFIXES:
            out.suffix = w
        elif d := re.fullmatch(r"(?:[a-z]|ld)?(\d{1,3})", w):
            out.district = int(d[1])
        elif w not in TITLES and w != "ld":
            out.tokens.append("st" if w == "saint" else w)
    return out


def encoded(x: Name) -> str:
    """A parsed name as a text, so that names that read alike are one; empty for no name."""
    if not x.tokens and not x.joined:
        return ""
    return "\x1f".join([" ".join(x.tokens), " ".join(x.nick), x.suffix, "\x1e".join(sorted(x.joined))])


@lru_cache(maxsize=KEPT)
def decoded(form: str) -> Name:
    """The name that :func:`encoded` wrote (but its district)."""
    tokens, nick, suffix, joined = form.split("\x1f")
    return Name(tokens.split(), nick.split(), suffix, None, frozenset(joined.split("\x1e")) if joined else frozenset())


def runs(x: Name) -> list[str]:
    """The words that may be a surname: joins of one to four neighbouring words, and joined keys."""
    n = len(x.tokens)
    own = {"".join(x.tokens[i:j]) for i in range(n) for j in range(i + 1, min(n, i + 4) + 1)}
    return sorted(own | set(x.joined))


def _made_of(text: str, words: frozenset[str]) -> bool:
    if not text:
        return True
    return any(text.startswith(w) and _made_of(text[len(w) :], words) for w in words if w)


def edits(a: str, b: str, most: int = 3) -> int:
    """Edits with swaps of neighbours (optimal string alignment), or most + 1 if more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            cost = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            new[j] = cost
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


@lru_cache(maxsize=KEPT)
def shape(word: str) -> str:
    """What scanning confuses is one shape: 0 and o, 1, i and l, rn and m, vv and w, c and e."""
    return word.replace("0", "o").replace("1", "l").replace("rn", "m").replace("vv", "w").replace("i", "l").replace("c", "e").replace("5", "s")


@lru_cache(maxsize=KEPT)
def word_cost(a: str, b: str) -> float:
    """0 for equal words, 0.4 for one scanned shape, else the edits; 9 beyond what a slip explains."""
    if a == b:
        return 0.0
    if shape(a) == shape(b):
        return 0.4
    least = min(len(a), len(b))
    allowed = 0 if least < 3 else 1 if least < 6 else 2
    d = edits(a, b, 2)
    return d if d <= allowed else 9.0


@dataclass
class Person:
    first: str
    middle: str
    last: str
    suffix: str
    used: str
    last_words: tuple[str, ...] = ()


@lru_cache(maxsize=KEPT)
def person(first: str | None, middle: str | None, last: str | None, suffix: str | None, used: str | None) -> Person:
    flat = lambda t: "".join(words_of(fold(repair(t or "")).replace("'", "").replace("’", "")))
    parts = tuple("st" if w == "saint" else w for w in words_of(fold(repair(last or "")).replace("'", "").replace("’", "")))
    called = words_of(fold(repair(used or "")))
    return Person(flat(first), flat(middle), "".join(parts), flat(suffix), called[0] if called else "", parts)


def first_cost(given: str, p: Person) -> float:
    """Cost of reading ``given`` as the first name of ``p``; 9 if it cannot be."""
    if given == p.first or given == p.used:
        return 0.0 if given == p.first else 0.05
    if len(given) == 1:
        return 0.4 if given == p.first[:1] else 0.5 if given == p.used[:1] else 9.0
    shorts = SHORT.get(p.first, frozenset())
    if given in shorts:
        return 0.1 if not p.used else 0.25
    best = min(word_cost(given, p.first), word_cost(given, p.used) if p.used else 9.0)
    if best < 9:
        return best * 0.6 + 0.1
    if len(given) >= 3 and p.first.startswith(given):
        return 0.4
    return 0.9 if any(len(s) > 3 and word_cost(given, s) <= 1 for s in shorts) else 9.0


def reading_cost(x: Name, p: Person, weights: Sequence[float] | None = None) -> float | None:
    """Cost of reading the typed name as this person, or None where it cannot be.

    A surname (of one or more words, perhaps run together or misspelt) is found among
    the words; the words left over are read as first name, middle name or initials.
    ``weights`` (one per word, 1 for the rarest) make slips in, and surplus of, rare
    words count more than those of words that many names have.
    """
    weight = dict(zip(x.tokens, weights)) if weights is not None else {}
    best: float | None = None
    n = len(x.tokens)
    options: list[tuple[float, list[str]]] = []
    for i in range(n):
        for j in range(i + 1, min(n, i + 4) + 1):
            joined = "".join(x.tokens[i:j])
            if abs(len(joined) - len(p.last)) > 2:
                continue
            cost = word_cost(joined, p.last)
            # An initial is part of a misspelt surname only in front, as in "O Drinuzon".
            single = [k for k in range(i, j) if len(x.tokens[k]) == 1]
            if cost >= 1 and single and not (single == [i] and j > i + 1 and p.last.startswith(x.tokens[i])):
                continue
            if cost < 9:
                options.append((cost * max((weight.get(t, 1.0) for t in x.tokens[i:j]), default=1.0), x.tokens[:i] + x.tokens[j:]))
    if x.joined and not any(c == 0 for c, _ in options):
        for k in x.joined:
            cost = word_cost(k, p.last)
            if cost < 9:
                options.append((cost, [t for t in x.tokens if t not in k or len(t) == 1 and t in p.first[:1] + p.middle[:1]]))
    if len(p.last_words) > 1 and not options:
        # "Yaramdane" for "de la Yaramdane", one half of a double name: only the longest part counts.
        main = max(p.last_words, key=len)
        for i, t in enumerate(x.tokens):
            if len(main) >= 5 and word_cost(t, main) <= 1:
                particles = set(p.last_words) - {main}
                options.append((0.6 + word_cost(t, main), [w for k, w in enumerate(x.tokens) if k != i and w not in particles]))
    for cost, given in options:
        total = cost + _given_cost(given, x, p, weight)
        if total < 9 and (best is None or total < best):
            best = total
    if best is None:
        return None
    if x.suffix and x.suffix != p.suffix:
        return None
    return best + (0.9 if p.suffix and not x.suffix else 0)


def _given_cost(given: list[str], x: Name, p: Person, weight: dict[str, float]) -> float:
    nick = min((first_cost(w, p) for w in x.nick), default=None)
    extra = 0.0 if nick is None else -0.05 if nick < 9 else 0.8
    if not given:
        return (1.0 if nick is None else nick + 0.1) + extra
    orders = [(given[0], given[1:])]
    if len(given) > 1:
        orders += [(given[k], given[:k] + given[k + 1 :]) for k in range(1, len(given))] if x.joined else [(given[-1], given[:-1])]
    if len(given) == 1 and len(given[0]) == 2 and p.middle and given[0] == p.first[:1] + p.middle[:1]:
        return 0.4 + extra
    best = 9.0
    for place, (first, rest) in enumerate(orders):
        cost = first_cost(first, p)
        if cost >= 9:
            continue
        cost += 0.0 if x.joined or not place else 0.3
        for w in rest:
            if p.middle and (w == p.middle or w == p.middle[0]):
                cost -= 0.05
            elif p.middle and len(w) > 1 and word_cost(w, p.middle) < 9:
                cost += 0.2
            elif w == p.used or w in SHORT.get(p.first, ()):
                cost += 0.05
            else:
                cost += (0.35 if not p.middle else 0.9) * weight.get(w, 1.0)
        best = min(best, cost)
    return best + extra


def as_person(x: Name) -> Person | None:
    """A typed name with a given name and a surname as the entry of a directory; else None."""
    if not 2 <= len(x.tokens) <= 5 or len(x.tokens[0]) < 2 or len(x.tokens[-1]) < 2:
        return None
    return Person(x.tokens[0], "".join(x.tokens[1:-1]), x.tokens[-1], x.suffix, x.nick[0] if x.nick else "", (x.tokens[-1],))


def grams(words: list[str], q: int = 3) -> set[str]:
    """Padded q-grams of every word of two or more letters."""
    return {f"^{w}$"[i : i + q] for w in words if len(w) > 1 for i in range(max(1, len(w) + 3 - q))}


# Committees ---------------------------------------------------------------------------------------


@lru_cache(maxsize=KEPT)
def committee_words(text: str | None) -> tuple[str, ...]:
    """Sorted topic words of a committee's name as typed, abbreviations as they stand."""
    if not text:
        return ()
    words = re.findall(r"[a-z0-9]+", fold(repair(text)).replace("'", ""))
    return tuple(sorted(w for w in words if w not in BODY_WORDS))


@lru_cache(maxsize=KEPT)
def bare(word: str) -> str:
    """A word without its vowels but the first letter: transit gives trnst."""
    return word[:1] + re.sub("[aeiou]", "", word[1:])


def same_topic(a: str, b: str) -> float:
    """Likeness of two topic words: 1 equal, less for slips and abbreviations, 0 for others."""
    if a == b:
        return 1.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if len(short) >= 3 and (long.startswith(short) or short == bare(long)):
        return 0.9
    cost = word_cost(a, b)
    return 0.85 if cost <= 1 else 0.7 if cost <= 2 and len(short) >= 7 else 0.0


def committee_likeness(a: tuple[str, ...], b: tuple[str, ...], weight) -> float:
    """Soft weighted likeness of two committees' words: every word must find its own partner;
    ``weight`` gives rare words more.  An acronym equals the name with those initials."""
    if not a or not b:
        return 0.0
    if len(a) != len(b):
        for x, y in ((a, b), (b, a)):
            if len(x) == 1 and 2 <= len(x[0]) <= 9 and len(y) > 1 and sorted(x[0]) == sorted(w[0] for w in y):
                return 0.8
        return 0.0
    left, total, got = list(b), 0.0, 0.0
    for w in sorted(a, key=lambda w: -max(same_topic(w, o) for o in b)):
        best = max(left, key=lambda o: same_topic(w, o))
        likeness = same_topic(w, best)
        if likeness == 0:
            return 0.0
        left.remove(best)
        own = max(weight(w), weight(best))
        total += own
        got += own * likeness
    return got / total if total else 0.0
