"""Canonical rewritings of names typed by people.

``parse_name`` turns one string into every reading that the rewriting rules allow: token order, nickname, initial,
legal form, particle and honorific rules.  Each reading is a ``Reading``; the Spark side (``llm.names``) explodes the
readings, equi-joins them and scores them by how rare a rewriting is.

Plain Python without state, so that it runs unchanged inside Arrow batches.  ``None``, blanks and placeholders have no
reading.
"""

from __future__ import annotations

import re
import unicodedata
from typing import NamedTuple

# What people write where no name is known.
PLACEHOLDERS = frozenset(
    ["n/a", "na", "nil", "none", "null", "unknown", "unknown unknown", "tbc", "tbd", "test", "test test", "pending",
     "not available", "not provided", "no name", "xxx", "-", "--", ".", "?"]
)
# Honorifics before a name.
HONORIFICS = frozenset("mr mrs ms miss dr eng prof sir madam sheikh sheikha mme mlle".split())
# Particles that belong to a surname and carry no identity.
PARTICLES = frozenset("al el bin ibn bint abu van von der den de del della di da dos la le".split())
# Legal forms, as written once dots and spaces are gone, and the form that they stand for.
LEGAL_FORMS = {
    "llc": "llc", "limited": "llc", "ltd": "llc", "company": "co", "co": "co", "establishment": "est", "est": "est",
    "fze": "fze", "fzco": "fzco", "fzc": "fzco", "group": "group", "grp": "group", "sons": "sons", "brothers": "bros", "bros": "bros",
    "inc": "inc", "plc": "plc", "pjsc": "pjsc", "corporation": "corp", "corp": "corp",
}
# Usual abbreviations in firm names.
TRADE_WORDS = {
    "trdg": "trading", "trad": "trading", "svcs": "services", "svc": "services", "service": "services", "gen": "general",
    "maint": "maintenance", "contg": "contracting", "cont": "contracting", "med": "medical", "supply": "supplies", "supp": "supplies",
    "logistic": "logistics", "eng": "engineering", "engg": "engineering", "cons": "consultants", "consultant": "consultants",
    "elec": "electromechanical", "tech": "technical", "int": "interior", "textile": "textiles", "work": "works", "wks": "works",
    "part": "parts", "tour": "tourism", "print": "printing", "mar": "marine", "intl": "international", "foodstuffs": "foodstuff",
}
# Nicknames and the given names that they stand for.
NICKNAMES = {
    "abby": "abigail", "alex": "alexander", "sasha": "alexander", "andy": "andrew", "barney": "barnaby", "bea": "beatrice", "becky": "rebecca",
    "bella": "isabella", "ben": "benjamin", "berto": "roberto", "beth": "elizabeth", "bill": "william", "billy": "william", "bob": "robert",
    "cathy": "catherine", "kate": "catherine", "chris": "christopher", "danny": "daniel", "dan": "daniel", "dave": "david", "debbie": "deborah",
    "dick": "richard", "rick": "richard", "dom": "dominic", "ed": "edward", "eddie": "edward", "ned": "edward", "etta": "henrietta",
    "flo": "florence", "fran": "francesca", "fred": "frederick", "freddie": "frederick", "gabe": "gabriel", "gene": "eugene",
    "georgie": "georgina", "greg": "gregory", "hal": "harold", "harry": "harold", "ibby": "ibrahim", "jackie": "jacqueline",
    "jim": "james", "joe": "joseph", "jon": "jonathan", "josie": "josephine", "judy": "judith", "kat": "katarina", "katya": "katarina", "ken": "kenneth",
    "kim": "kimberly", "kolya": "nikolai", "kostya": "konstantin", "larry": "lawrence", "leo": "leonardo", "liz": "elizabeth", "lizzie": "elizabeth",
    "mahmo": "mahmoud", "matt": "matthew", "mike": "michael", "mindy": "melinda", "moe": "mohammed", "nate": "nathaniel", "nick": "nicholas",
    "nicky": "nicolette", "paddy": "patrick", "pat": "patricia", "peggy": "margaret", "maggie": "margaret", "penny": "penelope", "pete": "peter",
    "pippa": "philippa", "renzo": "lorenzo", "ron": "ronald", "ronnie": "veronica", "roz": "rosalind", "sam": "samantha", "seb": "sebastian",
    "steve": "stephen", "sue": "susan", "tammy": "tamara", "tanya": "tatiana", "tasha": "natalia", "tess": "theresa", "tim": "timothy",
    "tom": "thomas", "tony": "anthony", "val": "valentina", "vicky": "victoria", "vince": "vincent", "will": "william", "yusi": "yusuf",
    "zach": "zachary", "zaina": "zainab", "zack": "zachary", "drew": "andrew", "lena": "elena", "misha": "mikhail",
}

_SOUNDS = tuple((re.compile(a), b) for a, b in (("e{2,}", "i"), ("o{2,}|ou", "u"), (r"(.)\1+", r"\1"), ("w", "u"), ("y", "i"), ("z", "s"), ("q", "k"), ("(?<=.)h", "")))
_SPACES = re.compile(r"\s+")


class Reading(NamedTuple):
    """One rewriting. ``given`` or ``middle`` of one letter is an initial; ``cost`` counts the rules that were needed.

    All parts are sounds; ``written`` is given and surname as they were written.
    """

    given: str
    middle: str
    surname: str
    cost: int
    written: str = ""


def sounds(token: str) -> str:
    """The token with its transliteration variants made alike: long vowels, w/ou, y/i, z/s, q/k, silent h, doubled letters."""
    for pattern, by in _SOUNDS:
        token = pattern.sub(by, token)
    return token


def plain(name: str | None) -> str:
    """Lower case without accents and outer or repeated spaces; ``""`` for null, blank and placeholder."""
    if name is None:
        return ""
    text = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c)).casefold()
    text = _SPACES.sub(" ", text.replace("’", "'")).strip()
    return "" if text in PLACEHOLDERS or not any(c.isalpha() for c in text) else text


def _tokens(text: str) -> list[str]:
    """Words; dotted initials fall apart into letters."""
    out: list[str] = []
    for word in text.replace("-", " ").replace("'", "").split():
        parts = [p for p in word.split(".") if p]
        if len(parts) > 1 and all(len(p) == 1 for p in parts):
            out += parts
        else:
            out += parts[:1] if len(parts) == 1 else parts
    return ["".join(c for c in t if c.isalnum()) for t in out if any(c.isalnum() for c in t)]


def _firm(text: str) -> Reading | None:
    """A firm's reading, if a legal form ends it: the rarest word first, trade words brought to their full form."""
    text = re.sub(r"^m/s+\b\.?\s*", "", text)
    swapped = text.split(" - ", 1)
    if len(swapped) == 2 and len(swapped[1].split()) == 1:
        text = f"{swapped[1]} {swapped[0]}"
    words = re.sub(r"\b(\w)\.(\w)\.(\w)\b\.?", r"\1\2\3", text.replace("&", " and "))
    words = re.sub(r"\bfz co\b", "fzco", words)
    tokens = [t for t in re.sub(r"[^\w ]", " ", words).split() if t != "and"]
    legal = [LEGAL_FORMS[t] for t in tokens if t in LEGAL_FORMS]
    core = [TRADE_WORDS.get(t, t) for t in tokens if t not in LEGAL_FORMS]
    if not legal or tokens[-1] not in LEGAL_FORMS or len(core) < 2:
        return None
    kind = "#" + "".join(sounds(t) for t in core[1:])
    return Reading(kind, "", sounds(core[0]), 0, f"{kind}|{core[0]}")


def _given(token: str) -> list[tuple[str, int]]:
    """The given names that a token may stand for."""
    full = NICKNAMES.get(token)
    if full is None and len(token) > 2:
        full = _BY_SOUND.get(sounds(token))
    if len(token) == 1:  # an initial stays as it is written
        return [(token, 0)]
    return [(sounds(full), 1)] if full else [(sounds(token), 0)]


_BY_SOUND = {sounds(k): v for k, v in NICKNAMES.items() if len(sounds(k)) > 2}
for _full in set(NICKNAMES.values()):
    _BY_SOUND.pop(sounds(_full), None)


def parse_name(name: str | None) -> list[Reading]:
    """Every reading of a name; none for null, blank and placeholder."""
    text = plain(name)
    if not text:
        return []
    firm = _firm(text)
    if firm:
        return [firm]
    head, comma, tail = text.partition(",")
    groups = [_tokens(tail), _tokens(head)] if comma and tail.strip() else [_tokens(text)]
    if groups[0] and groups[0][0] in HONORIFICS and len(groups[0]) > 1:
        groups[0] = groups[0][1:]
    elif groups[-1] and groups[-1][0] in HONORIFICS and len(groups[-1]) > 1:
        groups[-1] = groups[-1][1:]
    ordered = [t for g in groups for t in g]
    known = len(groups) == 2
    for at, token in enumerate(ordered):  # a particle says where the surname begins
        if token in PARTICLES and at + 1 < len(ordered) and not known:
            if at == 0:
                end = next(i for i, t in enumerate(ordered) if t not in PARTICLES or i == len(ordered) - 1)
                if len(ordered) > end + 1:
                    ordered = ordered[end + 1 :] + ordered[: end + 1]
                    known = True
            else:
                known = True
            break
    words = [t for i, t in enumerate(ordered) if t not in PARTICLES or i == len(ordered) - 1]
    if len(words) < 2:
        return []
    orders = [(words, 0)]
    if not known:
        orders.append((words[1:] + words[:1], 1))
    found = []
    for order, cost in orders:
        surname = sounds(order[-1])
        if len(order[-1]) < 2:
            continue
        middle = "".join(sounds(t) for t in order[1:-1])
        for given, extra in _given(order[0]):
            found.append(Reading(given, middle, surname, cost + extra, f"{NICKNAMES.get(order[0], order[0])}|{order[-1]}"))
    return found


def joined(name: str | None) -> list[str]:
    """The whole name as one word, for names whose spaces were lost or moved; the first form is the plainest.

    Honorifics go and a surname before a comma moves back; further forms have a nickname's full name, and no middle names.
    """
    text = plain(name)
    head, comma, tail = text.partition(",")
    words = (_tokens(tail) + _tokens(head)) if comma and tail.strip() else _tokens(text)
    if words and words[0] in HONORIFICS:
        words = words[1:]
    if not words:
        return []
    forms = [sounds("".join(words))]
    full = [NICKNAMES.get(words[0], words[0]), *words[1:]]
    more = [full]
    start = next((i for i, t in enumerate(words) if t in PARTICLES), 0)
    if 1 < start < len(words) - 1:  # a particle says where the surname begins: what stands between may be missing elsewhere
        more.append(full[:1] + full[start:])
    for form in more:
        form = sounds("".join(form))
        if form not in forms:
            forms.append(form)
    return forms
