"""License scans: ordered signature rules with a keyword gate and suppression of overlaps.

A rule is a regular expression over the lower-cased text with a label, a priority and
keywords; the expression runs only on texts that hold one of the keywords, whatever letters
stand next to it, which is looked up among the hashes of the distinct words of a batch.  The rules come from one table of licenses (names, versions, identifiers) and the
forms in which a license is granted, named, linked or tagged.  Of overlapping detections the
one with the higher priority comes first, then the longer one, then the earlier rule; detections
inside the interval of a better one are suppressed, those that only overlap one stay.  Base phrases are counted on the words
of the text, whatever the rules find.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanecast.llm.kernels import LOWER, NOT_ALNUM, batches, find_words, text_bytes

# phrases whose every place is counted, and their labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

BASE_CONFIDENCE = 0.8

# words of the gate end at every byte outside ASCII, too, as do those of regular expressions over bytes
GATE = NOT_ALNUM.copy()
GATE[0x80:] = True

# fixed values: label; names (regular expressions); versions; SPDX stem; page of the text
LICENSES = """
apache ; apache(?: software)? license ; 1.0 1.1 2.0 ; apache ; apache.org/licenses
mit ; mit(?:/x11| \\(expat\\))? licen[cs]e ; ; mit ; opensource.org/licenses/mit
mit ; expat licen[cs]e ; ; mit ; expat
x11 ; x11 licen[cs]e ; ; x11 ; x.org/licenses
mit-0 ; mit no attribution(?: licen[cs]e)? ; ; mit-0 ; opensource.org/licenses/mit-0
bsd-2-clause ; (?:simplified bsd|freebsd|bsd[ -]2[ -]clause|2[ -]clause bsd) licen[cs]e ; ; bsd-2-clause ; opensource.org/licenses/bsd-2-clause
bsd-3-clause ; (?:new bsd|modified bsd|revised bsd|bsd[ -]3[ -]clause|3[ -]clause bsd) licen[cs]e ; ; bsd-3-clause ; opensource.org/licenses/bsd-3-clause
bsd-4-clause ; (?:original bsd|bsd[ -]4[ -]clause|4[ -]clause bsd) licen[cs]e ; ; bsd-4-clause ; spdx.org/licenses/bsd-4-clause
0bsd ; (?:zero[ -]clause bsd|0bsd|bsd zero clause) licen[cs]e ; ; 0bsd ; opensource.org/licenses/0bsd
bsd ; bsd(?:[ -]style)? licen[cs]e ; ; bsd ; opensource.org/licenses/bsd-license
gpl ; (?:gnu )?general public licen[cs]e ; 1 2 3 ; gpl ; gnu.org/licenses/gpl
gpl ; gnu gpl ; 1 2 3 ; gpl ; gnu.org/copyleft/gpl
lgpl ; (?:gnu )?(?:lesser|library) general public licen[cs]e ; 2 2.1 3 ; lgpl ; gnu.org/licenses/lgpl
lgpl ; gnu lgpl ; 2 2.1 3 ; lgpl ; gnu.org/copyleft/lesser
agpl ; (?:gnu )?affero general public licen[cs]e ; 1 3 ; agpl ; gnu.org/licenses/agpl
agpl ; gnu agpl ; 1 3 ; agpl ; gnu.org/licenses/agpl-3
gfdl ; (?:gnu )?free documentation licen[cs]e ; 1.1 1.2 1.3 ; gfdl ; gnu.org/licenses/fdl
mpl ; mozilla public licen[cs]e ; 1.0 1.1 2.0 ; mpl ; mozilla.org/mpl
epl ; eclipse public licen[cs]e ; 1.0 2.0 ; epl ; eclipse.org/legal/epl
cddl ; common development and distribution licen[cs]e ; 1.0 1.1 ; cddl ; opensource.org/licenses/cddl
cpl ; common public licen[cs]e ; 1.0 ; cpl ; opensource.org/licenses/cpl
ipl ; ibm public licen[cs]e ; 1.0 ; ipl ; opensource.org/licenses/ipl
eupl ; european union public licen[cs]e ; 1.0 1.1 1.2 ; eupl ; joinup.ec.europa.eu/collection/eupl
osl ; open software licen[cs]e ; 1.0 2.0 2.1 3.0 ; osl ; opensource.org/licenses/osl
afl ; academic free licen[cs]e ; 1.1 1.2 2.0 2.1 3.0 ; afl ; opensource.org/licenses/afl
artistic ; artistic licen[cs]e ; 1.0 2.0 ; artistic ; perlfoundation.org/artistic
zlib ; zlib(?:/libpng)? licen[cs]e ; ; zlib ; zlib.net/zlib_license
libpng ; libpng licen[cs]e ; 2.0 ; libpng ; libpng.org/pub/png
isc ; isc licen[cs]e ; ; isc ; opensource.org/licenses/isc
bsl ; boost software licen[cs]e ; 1.0 ; bsl ; boost.org/license
busl ; business source licen[cs]e ; 1.1 ; busl ; mariadb.com/bsl11
sspl ; server side public licen[cs]e ; 1 ; sspl ; mongodb.com/licensing/server-side-public-license
elastic ; elastic licen[cs]e ; 1.0 2.0 ; elastic ; elastic.co/licensing/elastic-license
unlicense ; (?:the )?unlicense ; ; unlicense ; unlicense.org
wtfpl ; wtfpl ; 1 2 ; wtfpl ; wtfpl.net
wtfpl ; do what the fuck you want to public licen[cs]e ; 1 2 ; wtfpl ; wtfpl.net/about
python ; (?:python software foundation|psf) licen[cs]e ; 2 ; psf ; python.org/psf/license
php ; php licen[cs]e ; 3.0 3.01 ; php ; php.net/license
ruby ; ruby licen[cs]e ; ; ruby ; ruby-lang.org/en/about/license
postgresql ; postgresql licen[cs]e ; ; postgresql ; postgresql.org/about/licence
ms-pl ; microsoft public licen[cs]e ; ; ms-pl ; opensource.org/licenses/ms-pl
ms-rl ; microsoft reciprocal licen[cs]e ; ; ms-rl ; opensource.org/licenses/ms-rl
openssl ; openssl licen[cs]e ; ; openssl ; openssl.org/source/license
ofl ; (?:sil )?open font licen[cs]e ; 1.0 1.1 ; ofl ; scripts.sil.org/ofl
odbl ; open (?:data commons open )?database licen[cs]e ; 1.0 ; odbl ; opendatacommons.org/licenses/odbl
odc-by ; open data commons attribution licen[cs]e ; 1.0 ; odc-by ; opendatacommons.org/licenses/by
pddl ; (?:open data commons )?public domain dedication and licen[cs]e ; 1.0 ; pddl ; opendatacommons.org/licenses/pddl
ogl ; open government licen[cs]e ; 1.0 2.0 3.0 ; ogl-uk ; nationalarchives.gov.uk/doc/open-government-licence
cecill ; cecill(?: free software)? licen[cs]e ; 1.0 2.0 2.1 ; cecill ; cecill.info/licences
mulan ; mulan (?:psl|permissive software licen[cs]e) ; 1 2 ; mulanpsl ; license.coscl.org.cn/mulanpsl
ncsa ; (?:university of illinois/)?ncsa(?: open source)? licen[cs]e ; ; ncsa ; opensource.org/licenses/ncsa
vim ; vim licen[cs]e ; ; vim ; vimdoc.sourceforge.net
curl ; curl licen[cs]e ; ; curl ; curl.se/docs/copyright
tex ; latex project public licen[cs]e ; 1.0 1.2 1.3 ; lppl ; latex-project.org/lppl
apsl ; apple public source licen[cs]e ; 1.0 2.0 ; apsl ; opensource.apple.com/apsl
"""

# fixed values: elements of Creative Commons licenses, and their versions
CC_KINDS = {
    "by": "attribution", "by-sa": "attribution[ -]share[ -]?alike", "by-nc": "attribution[ -]non[ -]?commercial",
    "by-nd": "attribution[ -]no[ -]?deriv(?:ative)?s?", "by-nc-sa": "attribution[ -]non[ -]?commercial[ -]share[ -]?alike",
    "by-nc-nd": "attribution[ -]non[ -]?commercial[ -]no[ -]?deriv(?:ative)?s?",
}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# fixed values: label | priority | keywords | expression, for texts that name no license of the table
NOTICES = """
cc0 | 80 | cc0 | \\bcc0(?:[ -]1\\.0)?(?: universal)?\\b
cc0 | 80 | creativecommons | creativecommons\\.org/publicdomain/zero/1\\.0
public-domain | 60 | domain | (?:released|placed|dedicated|put) (?:in)?to the public domain
public-domain | 50 | domain | \\b(?:is|are) in the public domain\\b
cc | 30 | creative | \\bcreative commons\\b
permission | 55 | hereby | permission is hereby granted, free of charge, to any person
permission | 50 | permission | permission to use, copy, modify,? and(?:/or)? distribute
bsd | 55 | redistribution | redistribution and use in source and binary forms
warranty | 20 | without | without warrant(?:y|ies) of any kind
warranty | 20 | provided | \\bprovided ["']?as[ -]is["']?
copyright | 25 | copyright | \\bcopyright (?:\\(c\\) |© )?(?:19|20)[0-9]{2}(?:[ ,-]+(?:19|20)[0-9]{2})*
copyright | 25 | c | \\(c\\) (?:19|20)[0-9]{2}\\b
copyright | 15 | copyrighted | \\bcopyrighted (?:material|work)s?\\b
reserved | 40 | reserved | \\b(?:all|some|no other) rights reserved\\b
proprietary | 45 | proprietary | \\bproprietary (?:and confidential|information|software)\\b
proprietary | 40 | unauthorized unauthorised | \\bunauthori[sz]ed (?:copying|use|reproduction|distribution)\\b
no-reuse | 45 | not | \\bmay not be (?:reproduced|copied|republished|redistributed)\\b
no-reuse | 45 | without | \\b(?:copied|reproduced|used|redistributed) without (?:prior )?(?:written )?permission\\b
non-commercial | 40 | commercial noncommercial | \\b(?:for|not for|no) (?:non-?)?commercial use(?: only)?\\b
license-file | 20 | see | \\bsee (?:the )?licen[cs]e(?:\\.txt|\\.md)? file\\b
"""


class Rule(NamedTuple):
    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: re.Pattern
    confidence: float


def _rule(label: str, priority: int, keywords: str, expression: str, confidence: float) -> Rule:
    spaced = expression.replace("[ -]", r"[\s-]").replace(" ?", r"\s*").replace(" ", r"\s+")
    return Rule(label, priority, tuple(keywords.split()), re.compile(spaced.encode()), confidence)


def _keywords(name: str) -> str:
    """Letters and digits that every match of ``name`` holds: the longest outside groups and classes."""
    plain = re.sub(r"\((?:[^()]|\([^()]*\))*\)\??", " ", name).replace("licen[cs]e", " ")
    return max(re.findall(r"[a-z0-9]+", re.sub(r"\[[^]]*\]", " ", plain)), key=len, default="license licence")


def build_rules() -> list[Rule]:
    """All rules in order; higher priorities are more specific forms."""
    rules: list[Rule] = []
    for line in LICENSES.strip().splitlines():
        label, name, versions, stem, page = (x.strip() for x in line.split(";"))
        keyword = _keywords(name)
        for version in versions.split():
            exact = f"{label}-{version}"
            v = re.escape(version.removesuffix(".0")) + (r"(?:\.0)?" if "." not in version.removesuffix(".0") else "") + r"(?![0-9]|\.[0-9])"
            numbered = rf"{name},? (?:version |v\.? ?|)?{v}"
            rules.append(_rule(exact, 95, keyword, rf"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{numbered}", 0.99))
            rules.append(_rule(exact, 90, keyword, rf"\b{numbered}", 0.95))
            rules.append(_rule(exact, 92, "spdx", rf"spdx-license-identifier: ?{re.escape(stem)}-{v}", 1.0))
        rules.append(_rule(label, 75, keyword, rf"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{name}", 0.95))
        rules.append(_rule(label, 65, keyword, rf"\b{name}", 0.8))
        rules.append(_rule(label, 85, "spdx", rf"spdx-license-identifier: ?{re.escape(stem)}(?![a-z0-9])", 1.0))
        rules.append(_rule(label, 70, max(re.findall("[a-z0-9]+", page), key=len), re.escape(page), 0.9))
    for kind, words in CC_KINDS.items():
        for version in CC_VERSIONS:
            v = re.escape(version)
            code = kind.replace("-", "[ -]")
            rules.append(_rule(f"cc-{kind}-{version}", 90, "cc", rf"\bcc[ -]{code}[ -](?:v\.? ?)?{v}\b", 0.95))
            rules.append(_rule(f"cc-{kind}-{version}", 90, "creative", rf"creative commons {words} (?:licen[cs]e )?(?:version )?{v}", 0.95))
            rules.append(_rule(f"cc-{kind}-{version}", 92, "creativecommons", rf"creativecommons\.org/licenses/{kind}/{v}", 0.99))
        rules.append(_rule(f"cc-{kind}", 65, "cc", rf"\bcc[ -]{kind.replace('-', '[ -]')}\b", 0.8))
        rules.append(_rule(f"cc-{kind}", 60, "creative", rf"creative commons {words}", 0.85))
    for line in NOTICES.strip().splitlines():
        label, priority, keyword, expression = (x.strip() for x in line.split(" | ", 3))
        rules.append(_rule(label, int(priority), keyword, expression, int(priority) / 100))
    return rules


def keyword_gate(rules: list[Rule]) -> list[tuple[bytes, tuple[int, ...]]]:
    """All keywords and the rules that each opens."""
    numbers: dict[str, list[int]] = {}
    for i, rule in enumerate(rules):
        for keyword in rule.keywords:
            numbers.setdefault(keyword, []).append(i)
    return [(k.encode(), tuple(x)) for k, x in numbers.items()]


def open_rules(low: np.ndarray, offsets: np.ndarray, gate: list[tuple[bytes, tuple[int, ...]]]) -> dict[int, set[int]]:
    """Rules to run per text: those with a keyword anywhere in a word (one letter: a whole word)."""
    words = find_words(low, offsets, GATE)
    _, at, which = np.unique(words.hash, return_index=True, return_inverse=True)
    raw = low.tobytes()
    listed = b"\n" + b"".join(raw[a:b] + b"\n" for a, b in zip(words.start[at].tolist(), words.end[at].tolist(), strict=True))
    starts = np.cumsum(words.end[at] - words.start[at] + 1) + 1  # of the next word
    opens: dict[int, set[int]] = {}
    for keyword, numbers in gate:
        wanted = keyword if len(keyword) > 1 else b"\n" + keyword + b"\n"
        places, place = [], listed.find(wanted)
        while place >= 0:
            places.append(place + len(wanted) - len(keyword) - (len(keyword) == 1))
            place = listed.find(wanted, place + 1)
        for k in set(np.searchsorted(starts, places, "right").tolist()):
            opens.setdefault(k, set()).update(numbers)
    some = np.zeros(len(at), bool)
    some[list(opens)] = True
    hits = np.flatnonzero(some[which]) if len(at) else at
    opened: dict[int, set[int]] = {}
    pairs = {*zip((np.searchsorted(words.first, hits, "right") - 1).tolist(), which[hits].tolist(), strict=True)}
    for row, k in pairs:
        opened.setdefault(row, set()).update(opens[k])
    return opened


def _hashes(phrase: str) -> np.ndarray:
    return find_words(*text_bytes(pa.array([phrase])), NOT_ALNUM).hash


def _letter(text: bytes, at: int, step: int) -> bool:
    """Whether a letter outside ASCII of a script with capitals, such as é, ends or starts at a byte."""
    near = text[max(0, at - 16) : at] if step < 0 else text[at : at + 16]
    one = near.decode(errors="ignore")[-1 if step < 0 else 0 :][:1]
    return one > "\x7f" and (one.lower() != one.upper() or unicodedata.combining(one) > 0)


def _apart(m: re.Match) -> bool:
    """Whether the word borders of a rule hold for letters outside ASCII, too."""
    text, pattern = m.string, m.re.pattern
    if pattern.startswith(b"\\b") and _letter(text, m.start(), -1):
        return False
    return not (pattern.endswith(b"\\b") and _letter(text, m.end(), 1))


def detect(text: bytes, rules: list[Rule], opened: set[int]) -> list[tuple[int, int, int]]:
    """Surviving detections (rule, start, end) of the opened rules in one lower-cased text, by start."""
    found = []
    for i in opened:
        found += [(i, m.start(), m.end()) for m in rules[i].pattern.finditer(text) if m.end() > m.start() and _apart(m)]
    # better ones first; a detection goes if it lies inside a better one
    found.sort(key=lambda x: (-rules[x[0]].priority, x[1] - x[2], x[1], x[0]))
    kept: list[tuple[int, int, int]] = []
    starts: list[int] = []  # of the kept intervals inside no other one, and their ends
    ends: list[int] = []
    for one in found:
        _, a, b = one
        at = bisect_right(starts, a)
        if at and ends[at - 1] >= b:
            continue
        at = stop = bisect_left(starts, a)
        while stop < len(ends) and ends[stop] <= b:
            stop += 1
        starts[at:stop], ends[at:stop] = [a], [b]
        kept.append(one)
    return sorted(kept, key=lambda x: x[1])


def _base_places(words, phrases: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(word, phrase) of all places at which a phrase's words stand consecutively in one text."""
    places, which = [], []
    last = words.first[1:][words.owner()] if len(words.hash) else words.hash
    for k, phrase in enumerate(phrases):
        n = len(words.hash) - len(phrase) + 1
        if n <= 0:
            continue
        hit = words.hash[:n] == phrase[0]
        for j in range(1, len(phrase)):
            hit &= words.hash[j : j + n] == phrase[j]
        at = np.flatnonzero(hit)
        at = at[at + len(phrase) <= last[at]]
        places.append(at)
        which.append(np.full(len(at), k))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(which)


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels`` (sorted arrays), ``score`` and the ``detections`` that stay
    after suppression (label, priority, first and last character + 1 of the span).

    Words are runs of letters and digits after lower-casing A-Z.  The score is
    1 - prod(1 - confidence) over distinct labels, 0 without any.  A missing or empty text
    has no words, no labels and null places.  Repeated rows stay repeated and missing ids
    missing; other columns are not read.
    """
    rules = build_rules()
    names = np.array(list(BASE.values()))
    phrases = [_hashes(p) for p in BASE]
    schema = (
        "id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, "
        "score double, detections array<struct<label: string, priority: int, start: long, end: long>>"
    )
    kind = pa.struct([("label", pa.string()), ("priority", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(stream):
        gate = keyword_gate(rules)
        for batch in stream:
            raw, offsets = text_bytes(batch.column(1))
            n = len(offsets) - 1
            n_words, n_base = np.zeros(n, np.int64), np.zeros(n, np.int64)
            first, last, score = np.full(n, -1), np.full(n, -1), np.zeros(n)
            base, labels, found = [[] for _ in range(n)], [[] for _ in range(n)], [[] for _ in range(n)]
            for a, b in batches(offsets):
                low, own = LOWER[raw[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
                words = find_words(low, own, NOT_ALNUM)
                n_words[a:b] = words.counts
                sure: dict[int, dict[str, float]] = {}
                place, which = _base_places(words, phrases)
                for w, k in zip(place.tolist(), which.tolist(), strict=True):
                    row = int(np.searchsorted(words.first, w, "right")) - 1
                    at, i = w - words.first[row], a + row
                    n_base[i] += 1
                    first[i] = at if first[i] < 0 else min(first[i], at)
                    last[i] = max(last[i], at)
                    sure.setdefault(row, {})[names[k]] = BASE_CONFIDENCE
                for row, own_base in sure.items():
                    base[a + row] = sorted(map(str, own_base))
                for row, numbers in open_rules(low, own, gate).items():
                    part = low[own[row] : own[row + 1]].tobytes()
                    wide = not part.isascii()
                    for r, s, e in detect(part, rules, numbers):
                        rule, mine = rules[r], sure.setdefault(row, {})
                        mine[rule.label] = max(mine.get(rule.label, 0.0), rule.confidence)
                        s, e = (len(part[:x].decode(errors="ignore")) if wide else x for x in (s, e))
                        found[a + row].append({"label": rule.label, "priority": rule.priority, "start": s, "end": e})
                for row, mine in sure.items():
                    labels[a + row] = sorted(map(str, mine))
                    score[a + row] = 1.0 - float(np.prod([1.0 - mine[x] for x in sorted(mine)]))
            none, strings = n_base == 0, pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
                 pa.array(base, strings), pa.array(labels, strings), pa.array(score), pa.array(found, pa.list_(kind))],
                names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"],
            )

    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return plain.mapInArrow(scan, schema).withColumnRenamed("id", id_column)
