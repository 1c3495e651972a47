"""License scans by ordered signature rules.

Every rule is a regular expression with a label and a priority. What literals
every match must hold is derived from the expression, and it runs only on texts
that hold them. Of the places found, those of higher
priority (then longer, then earlier) are taken first, and a place that lies
within a taken one is suppressed: "lesser general public license" is no mention
of the GPL, and a tag "MIT-0" none of MIT.

Besides, four base phrases are counted wherever their words stand one after
another; these labels stay whatever the rules say.

Texts are read as bytes with A-Z lower-cased. Words are runs of digits, letters
and bytes beyond ASCII. Null and empty texts have no words and no labels.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.base import ALNUM, LOWER, blocks, each_bytes, scan, split_words, utf8

# Phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_WORD = rb"[0-9a-z\x80-\xff]"
_BREAK = rb"[^0-9a-z\x80-\xff]+"


def phrase(text: str) -> re.Pattern[bytes]:
    """The words one after another, whatever stands between them."""
    words = _BREAK.join(re.escape(w.encode()) for w in text.split())
    return re.compile(rb"(?<!%b)%b(?!%b)" % (_WORD, words, _WORD))


@dataclass(frozen=True)
class Rule:
    """priority 4: machine-readable tag; 3: address; 2: full name or wording; 1: short mention."""

    label: str
    priority: int
    needs: list[frozenset[bytes]]
    pattern: re.Pattern[bytes]


CONFIDENCE = {4: 1.0, 3: 0.95, 2: 0.9, 1: 0.6}
BASE_CONFIDENCE = 0.8

# Label, identifiers in tags, the name as written in prose, address. One line a license.
_LICENSES = r"""
mit :: mit :: (?:the )?mit(?: \(expat\))? licen[sc]e|licen[sc]ed under (?:the )?mit(?=\s*(?:[.,;:)\]"'/\n(]|licen[sc]e|terms|and|or|\Z))|expat licen[sc]e :: opensource\.org/licenses?/mit(?![\w-])
mit-0 :: mit-0 :: mit no[ -]attribution(?: licen[sc]e)? :: opensource\.org/licenses?/mit-0
x11 :: x11 :: x11 licen[sc]e|mit/x11 licen[sc]e ::
apache :: apache-2\.0|apache-1\.[01] :: apache(?: software)? licen[sc]e(?:,? (?:version )?[12]\.\d)? :: apache\.org/licenses/license-[12]\.\d
gpl :: gpl-[123]\.0(?:-only|-or-later|\+)?|gpl-1\.0 :: gnu general public licen[sc]e(?:,? (?:version |v)?[123](?:\.0)?)?(?: or (?:any )?later(?: version)?)? :: gnu\.org/licenses/(?:old-licenses/)?gpl
lgpl :: lgpl-[23]\.[01](?:-only|-or-later|\+)? :: gnu (?:lesser|library) general public licen[sc]e(?:,? (?:version |v)?[23](?:\.[01])?)? :: gnu\.org/licenses/(?:old-licenses/)?lgpl
agpl :: agpl-[13]\.0(?:-only|-or-later|\+)? :: (?:gnu )?affero general public licen[sc]e(?:,? (?:version |v)?[13](?:\.0)?)? :: gnu\.org/licenses/agpl
gfdl :: gfdl-1\.[123](?:-only|-or-later)? :: gnu free documentation licen[sc]e(?:,? version 1\.[123])? :: gnu\.org/licenses/(?:old-licenses/)?fdl
bsd-2-clause :: bsd-2-clause(?:-patent|-views)? :: (?:simplified|freebsd|2-clause|two-clause) bsd(?: 2-clause)? licen[sc]e|bsd[ -]2[ -]clause :: opensource\.org/licenses?/bsd-2-clause
bsd-3-clause :: bsd-3-clause(?:-clear)? :: (?:new|revised|modified|3-clause|three-clause) bsd licen[sc]e|bsd[ -]3[ -]clause :: opensource\.org/licenses?/bsd-3-clause
bsd-4-clause :: bsd-4-clause :: (?:original|4-clause|four-clause) bsd licen[sc]e|bsd[ -]4[ -]clause ::
0bsd :: 0bsd :: zero[ -]clause bsd|bsd zero[ -]clause licen[sc]e :: opensource\.org/licenses?/0bsd
isc :: isc :: isc licen[sc]e :: opensource\.org/licenses?/isc
mpl :: mpl-[12]\.[01] :: mozilla public licen[sc]e(?:,? (?:version |v)?[12]\.[01])? :: mozilla\.org/(?:en-us/)?mpl
epl :: epl-[12]\.0 :: eclipse public licen[sc]e(?:,? (?:- )?(?:version |v)?\s?[12]\.0)? :: eclipse\.org/(?:legal/epl|org/documents/epl)
edl :: edl-1\.0 :: eclipse distribution licen[sc]e :: eclipse\.org/org/documents/edl
cddl :: cddl-1\.[01] :: common development and distribution licen[sc]e :: opensource\.org/licenses?/cddl
cpl :: cpl-1\.0 :: common public licen[sc]e(?! attribution) :: opensource\.org/licenses?/cpl
cpal :: cpal-1\.0 :: common public attribution licen[sc]e :: opensource\.org/licenses?/cpal
artistic :: artistic-[12]\.0(?:-perl)? :: (?:the )?(?:perl )?artistic licen[sc]e(?: [12]\.0)? :: opensource\.org/licenses?/artistic
zlib :: zlib :: zlib(?:/libpng)? licen[sc]e :: zlib\.net/zlib_license|opensource\.org/licenses?/zlib
libpng :: libpng(?:-2\.0)? :: (?<!zlib/)libpng licen[sc]e(?: version 2)? :: libpng\.org/pub/png/src/libpng-license
boost :: bsl-1\.0 :: boost software licen[sc]e(?:,? (?:version )?1\.0)? :: boost\.org/license_1_0
unlicense :: unlicense :: (?:the )?unlicen[sc]e(?!d) :: unlicense\.org
wtfpl :: wtfpl :: do what the f\S{1,3} you want to public licen[sc]e :: wtfpl\.net
cc0 :: cc0-1\.0 :: cc0(?:[ -]1\.0)?(?: universal)?(?: public domain dedication)? :: creativecommons\.org/publicdomain/zero
cc-pdm :: cc-pddc :: public domain (?:mark|dedication)(?: 1\.0)? :: creativecommons\.org/publicdomain/mark
cc-by :: cc-by-[1234]\.[05] :: creative commons attribution(?: [1234]\.[05])?(?: international| unported| generic)?(?: licen[sc]e)?(?![- ](?:non|share|no)) :: creativecommons\.org/licenses/by/
cc-by-sa :: cc-by-sa-[1234]\.[05] :: (?:creative commons )?attribution[ -]share[ -]?alike(?: [1234]\.[05])? :: creativecommons\.org/licenses/by-sa/
cc-by-nd :: cc-by-nd-[1234]\.[05] :: (?:creative commons )?attribution[ -]no[ -]?deriv(?:ative)?s?(?: works)?(?: [1234]\.[05])? :: creativecommons\.org/licenses/by-nd/
cc-by-nc :: cc-by-nc-[1234]\.[05] :: (?:creative commons )?attribution[ -]non[ -]?commercial(?! ?-? ?(?:share|no))(?: [1234]\.[05])? :: creativecommons\.org/licenses/by-nc/
cc-by-nc-sa :: cc-by-nc-sa-[1234]\.[05] :: (?:creative commons )?attribution[ -]non[ -]?commercial[ -]share[ -]?alike(?: [1234]\.[05])? :: creativecommons\.org/licenses/by-nc-sa/
cc-by-nc-nd :: cc-by-nc-nd-[1234]\.[05] :: (?:creative commons )?attribution[ -]non[ -]?commercial[ -]no[ -]?deriv(?:ative)?s?(?: [1234]\.[05])? :: creativecommons\.org/licenses/by-nc-nd/
eupl :: eupl-1\.[012] :: european union public licen[sc]e(?:,? (?:version |v\.? ?)?1\.[012])? :: joinup\.ec\.europa\.eu/\S*eupl
python :: psf-2\.0|python-2\.0 :: python software foundation licen[sc]e(?: version 2)?|\bpsf licen[sc]e :: docs\.python\.org/\S*license
php :: php-3\.0[01]? :: php licen[sc]e(?:,? version 3\.0[01]?)? :: php\.net/license
ruby :: ruby :: ruby licen[sc]e :: ruby-lang\.org/\S*license
openssl :: openssl :: openssl licen[sc]e|openssl toolkit :: openssl\.org/source/license
postgresql :: postgresql :: postgresql licen[sc]e :: postgresql\.org/about/licen[sc]e
w3c :: w3c(?:-\d{8})? :: w3c software(?: notice)?(?: and)? licen[sc]e :: w3\.org/consortium/legal
ofl :: ofl-1\.[01](?:-rfn|-no-rfn)? :: (?:sil )?open font licen[sc]e(?:,? (?:version )?1\.[01])? :: scripts\.sil\.org/ofl|openfontlicense\.org
odbl :: odbl-1\.0 :: open database licen[sc]e(?: v?1\.0)? :: opendatacommons\.org/licenses/odbl
odc-by :: odc-by-1\.0 :: open data commons attribution licen[sc]e :: opendatacommons\.org/licenses/by
pddl :: pddl-1\.0 :: (?:open data commons )?public domain dedication and licen[sc]e :: opendatacommons\.org/licenses/pddl
ms-pl :: ms-pl :: microsoft public licen[sc]e :: opensource\.org/licenses?/ms-pl
ms-rl :: ms-rl :: microsoft reciprocal licen[sc]e :: opensource\.org/licenses?/ms-rl
osl :: osl-[123]\.[01] :: open software licen[sc]e(?: (?:version |v\.? ?)?[123]\.[01])? :: opensource\.org/licenses?/osl
afl :: afl-[123]\.[0-2] :: academic free licen[sc]e(?: (?:version |v\.? ?)?[123]\.[0-2])? :: opensource\.org/licenses?/afl
ecl :: ecl-[12]\.0 :: educational community licen[sc]e :: opensource\.org/licenses?/ecl
ncsa :: ncsa :: university of illinois/ncsa open source licen[sc]e|ncsa licen[sc]e :: opensource\.org/licenses?/ncsa
upl :: upl-1\.0 :: universal permissive licen[sc]e(?: (?:version |v)?1\.0)? :: opensource\.org/licenses?/upl
blueoak :: blueoak-1\.0\.0 :: blue oak model licen[sc]e :: blueoakcouncil\.org/license
vim :: vim :: vim licen[sc]e :: vimhelp\.org/uganda
qpl :: qpl-1\.0 :: q public licen[sc]e :: opensource\.org/licenses?/qtpl
ipl :: ipl-1\.0 :: ibm public licen[sc]e :: opensource\.org/licenses?/ipl
npl :: npl-1\.[01] :: netscape public licen[sc]e :: mozilla\.org/mpl/npl
spl :: spl-1\.0 :: sun public licen[sc]e :: opensource\.org/licenses?/sunpublic
apsl :: apsl-[12]\.[0-2] :: apple public source licen[sc]e :: opensource\.apple\.com/\S*apsl
rpl :: rpl-1\.[15] :: reciprocal public licen[sc]e :: opensource\.org/licenses?/rpl
sspl :: sspl-1\.0 :: server side public licen[sc]e(?:,? (?:version |v)?1)? :: mongodb\.com/licensing/server-side
busl :: busl-1\.1 :: business source licen[sc]e(?: 1\.1)? :: mariadb\.com/bsl
elastic :: elastic-2\.0 :: elastic licen[sc]e(?: (?:v|version )?2(?:\.0)?)? :: elastic\.co/licensing/elastic-license
commons-clause :: commons-clause :: commons clause(?: licen[sc]e condition)? :: commonsclause\.com
polyform :: polyform-(?:noncommercial|small-business|strict|shield|perimeter)-1\.0\.0 :: polyform (?:noncommercial|small business|strict|shield|perimeter|free trial) licen[sc]e :: polyformproject\.org/licenses
json :: json :: the software shall be used for good,? not evil :: json\.org/license
beerware :: beerware :: beer[ -]?ware licen[sc]e|the beer-ware :: people\.freebsd\.org/~phk
mulan :: mulanpsl-[12]\.0 :: mulan (?:psl|permissive software licen[sc]e)(?:,? ?v?[12])? :: license\.coscl\.org\.cn/mulanpsl
cecill :: cecill-(?:[12]\.[01]|b|c) :: cecill(?:-[bc])?(?: free software)? licen[sc]e(?: agreement)? :: cecill\.info/licences
lppl :: lppl-1\.(?:0|1|2|3a|3c) :: latex project public licen[sc]e :: latex-project\.org/lppl
ogl :: ogl-uk-[123]\.0 :: open government licen[sc]e(?: v?[123]\.0)? :: nationalarchives\.gov\.uk/doc/open-government-licence
etalab :: etalab-2\.0 :: licence ouverte(?: / open licence)?(?: (?:version |v)?[12]\.0)? :: etalab\.gouv\.fr/licence-ouverte
hpnd :: hpnd :: historical permission notice and disclaimer :: opensource\.org/licenses?/hpnd
ntp :: ntp(?:-0)? :: ntp licen[sc]e :: opensource\.org/licenses?/ntp
unicode :: unicode-(?:dfs-201[56]|3\.0|tou) :: unicode(?:, inc\.)? licen[sc]e(?: agreement)?|unicode licen[sc]e v3 :: unicode\.org/(?:copyright|license)
openrail :: openrail(?:\+\+|-m)? :: (?:bigscience |creativeml )?open ?rail(?:\+\+)?(?:-m)?(?: licen[sc]e)? :: huggingface\.co/spaces/\S*license
"""

# Label, priority, expression: wording that no scheme covers.
_WORDINGS = r"""
mit :: 2 :: permission is hereby granted, free of charge, to any person obtaining a copy of this software
isc :: 2 :: permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted
apache :: 2 :: you may not use this file except in compliance with the license
gpl :: 2 :: redistribute it and/or modify it under the terms of the gnu general public licen[sc]e
lgpl :: 2 :: redistribute it and/or modify it under the terms of the gnu lesser general public licen[sc]e
agpl :: 2 :: redistribute it and/or modify it under the terms of the gnu affero general public licen[sc]e
bsd :: 2 :: redistribution and use in source and binary forms, with or without modification, are permitted
bsd-3-clause :: 2 :: neither the name of .{1,80}? may be used to endorse or promote products
bsd-4-clause :: 2 :: all advertising materials mentioning features or use of this software must display
mpl :: 2 :: this source code form is subject to the terms of the mozilla public licen[sc]e
epl :: 2 :: made available under the terms of the eclipse public licen[sc]e
zlib :: 2 :: this software is provided 'as-is', without any express or implied warranty
boost :: 2 :: distributed under the boost software licen[sc]e
unlicense :: 2 :: this is free and unencumbered software released into the public domain
public-domain :: 2 :: (?:released|dedicated|placed|is) (?:in|into|to) the public domain
proprietary :: 2 :: all rights reserved
proprietary :: 2 :: (?:proprietary and confidential|confidential and proprietary)
proprietary :: 2 :: unauthori[sz]ed (?:copying|use|reproduction|distribution) (?:of this \w+ )?(?:is )?(?:strictly )?prohibited
proprietary :: 2 :: may not be (?:copied|reproduced|distributed|republished) without (?:prior )?(?:written )?permission
lgpl :: 2 :: (?:gnu )?lesser general public licen[sc]e
lgpl :: 2 :: (?:gnu )?library general public licen[sc]e
gpl :: 1 :: (?<!lesser )(?<!library )(?<!affero )general public licen[sc]e
gpl :: 1 :: (?<![\w-])gplv?[ -]?[23](?:\.0)?\+?(?![\w-])
gpl :: 1 :: under (?:the )?gpl(?![\w-])
lgpl :: 1 :: (?<![\w-])lgplv?[ -]?[23](?:\.[01])?\+?(?![\w-])
agpl :: 1 :: (?<![\w-])agplv?[ -]?3(?:\.0)?\+?(?![\w-])
apache :: 1 :: (?:under|with) apache[ -]?2(?:\.0)?|(?<![\w-])apache[ -]2(?:\.0)?(?![\w-])
bsd :: 1 :: (?<![\w-])bsd(?:-style)? licen[sc]e
mit :: 1 :: mit-style licen[sc]e
mit :: 1 :: under (?:the )?mit(?=\s*(?:[.,;:)\]"'/\n(]|licen[sc]e|terms|and|or|\Z))
mpl :: 1 :: (?<![\w-])mpl[ -]?[12]\.[01](?![\w-])
epl :: 1 :: (?<![\w-])epl[ -]?[12]\.0(?![\w-])
cc-by :: 2 :: (?<![\w-])cc[ -]by(?:[ -][1234]\.[05])?(?![ -](?:nc|nd|sa)|\w)
cc-by-sa :: 2 :: (?<![\w-])cc[ -]by[ -]sa(?:[ -][1234]\.[05])?(?!\w)
cc-by-nd :: 2 :: (?<![\w-])cc[ -]by[ -]nd(?:[ -][1234]\.[05])?(?!\w)
cc-by-nc :: 2 :: (?<![\w-])cc[ -]by[ -]nc(?:[ -][1234]\.[05])?(?![ -](?:nd|sa)|\w)
cc-by-nc-sa :: 2 :: (?<![\w-])cc[ -]by[ -]nc[ -]sa(?:[ -][1234]\.[05])?(?!\w)
cc-by-nc-nd :: 2 :: (?<![\w-])cc[ -]by[ -]nc[ -]nd(?:[ -][1234]\.[05])?(?!\w)
cc0 :: 1 :: creative commons zero
creative-commons :: 1 :: (?<!\w)creative commons(?: licen[sc]e)?(?! (?:attribution|zero))
dual :: 1 :: dual[ -]licen[sc]ed
open-source :: 1 :: osi[ -]approved (?:open source )?licen[sc]e
"""


_PART = re.compile(r"\[[^\]]*\]|\(\?<!.*?\)| \?| ")


def _compiled(expression: str) -> re.Pattern[bytes]:
    """A space stands for any white space: one character in a class or behind, none or more before a question mark."""

    def spaced(m: re.Match[str]) -> str:
        part = m.group()
        return {" ?": r"\s*", " ": r"\s+"}.get(part, part.replace(" ", r"\s"))

    return re.compile(_PART.sub(spaced, expression.strip()).encode("latin-1"), re.DOTALL)


_NAME_END = r"(?![\w\x80-\xff])"


def _rules() -> list[Rule]:
    rules = []
    for line in _LICENSES.strip().splitlines():
        label, tags, name, address = re.split(" :: ?", line)
        tag = rf"(?:spdx-license-identifier\s*:\s*|licen[sc]e\s*[:=]\s*[\"']?)\(?(?:{tags})(?![\w.+-]*\w)"
        in_list = rf"spdx-license-identifier\s*:[^\n]{{0,200}}?\b(?:or|and|with)\s+\(?(?P<at>{tags})(?![\w.+-]*\w)"
        rules += [_rule(label, 4, tag), _rule(label, 4, in_list)]
        if address.strip():
            rules.append(_rule(label, 3, rf"(?:https?://)?(?:www\.)?(?:{address.strip()})[\w./-]*"))
        # a name ends as a word does: closed by its own last letter or a plural's, and nothing of a word after it
        rules.append(_rule(label, 2, rf"(?<![\w\x80-\xff])(?:{name})s?{_NAME_END}"))
    for line in _WORDINGS.strip().splitlines():
        label, priority, expression = line.split(" :: ")
        rules.append(_rule(label, int(priority), rf"{expression}{_NAME_END}"))
    return rules


def needs(pattern: re.Pattern[bytes]) -> list[frozenset[bytes]]:
    """Sets of literals; every match holds one of each set."""

    def of(parsed) -> list[frozenset[bytes]]:
        out, run = [], b""
        for op, value in [*parsed, (None, None)]:
            if op is _parser.LITERAL:
                run += bytes([value])
                continue
            if len(run) > 1:
                out.append(frozenset([run]))
            run = b""
            if op is _parser.SUBPATTERN:
                out += of(value[-1])
            elif op in (_parser.MAX_REPEAT, _parser.MIN_REPEAT) and value[0]:
                out += of(value[2])
            elif op is _parser.BRANCH:
                ways = [max(of(way), key=lambda literals: min(map(len, literals)), default=None) for way in value[1]]
                if all(ways):
                    out.append(frozenset().union(*ways))
        return out

    return of(_parser.parse(pattern.pattern, pattern.flags))


def _rule(label: str, priority: int, expression: str) -> Rule:
    pattern = _compiled(expression)
    return Rule(label, priority, needs(pattern), pattern)


class Scanner:
    """The rules by the literals they need, and the base phrases."""

    def __init__(self) -> None:
        rules = _rules()
        uses = Counter(literals for rule in rules for literals in set(rule.needs))
        #: What many rules need is looked for first; where it is missing, none of them costs more.
        self.by_needs: dict[tuple[frozenset[bytes], ...], list[tuple[int, Rule]]] = {}
        for order, rule in enumerate(rules):
            sets = sorted(set(rule.needs), key=lambda literals: (-uses[literals], sorted(literals)))
            self.by_needs.setdefault(tuple(sets), []).append((order, rule))
        self.base = [(text.split()[0].encode(), phrase(text), label) for text, label in BASE.items()]

    def places(self, text: bytes) -> list[tuple[int, int, Rule]]:
        """What the rules find in a lower-cased text, less what lies within a place taken before."""
        found = []
        held: dict[frozenset[bytes], bool] = {}
        for sets, rules in self.by_needs.items():
            for literals in sets:
                if literals not in held:
                    held[literals] = any(x in text for x in literals)
                if not held[literals]:
                    break
            else:
                for order, rule in rules:
                    part = "at" if "at" in rule.pattern.groupindex else 0  # of a list of tags, the tag itself
                    found += [(m.start(part), -m.end(part), -rule.priority, order, rule) for m in rule.pattern.finditer(text)]
        return unsuppressed(found)

    def base_places(self, text: bytes) -> list[tuple[int, str]]:
        """Byte where each base phrase begins, and its label."""
        out = []
        for first, pattern, label in self.base:
            if first in text:
                out += [(m.start(), label) for m in pattern.finditer(text)]
        return out


def unsuppressed(found: list[tuple[int, int, int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Places (start, -end, -priority, order, rule) that lie within none of as high a priority, by place.

    What holds a place holds all within it, so it doesn't matter whether it is itself suppressed, and a sweep for
    each priority does.
    """
    found = sorted(found, key=lambda f: f[:4])
    out = []
    for level in sorted({f[2] for f in found}):
        reach = -1
        for start, end, priority, _, rule in found:
            if priority <= level:
                if priority == level and -end > reach:
                    out.append((start, -end, rule))
                reach = max(reach, -end)
    return sorted(out, key=lambda t: (t[0], t[1], t[2].label))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row for each row of docs (doc_id, text).

    doc_id, n_words; n_base, first_word, last_word and base_labels of the base phrases; labels, of base phrases and
    rules; spans, the places (label, start and end byte, priority) that rules found; score, the highest confidence.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in blocks(batches):
            data, offsets = utf8(batch.column("text"))
            starts, _, first = split_words(data, offsets, ALNUM)
            rows = []
            for k, text in enumerate(each_bytes(batch.column("text"))):
                text = text.translate(LOWER)
                base = scanner.base_places(text)
                words = np.searchsorted(starts, offsets[k] + np.array([at for at, _ in base], np.int64)) - first[k]
                places = scanner.places(text)
                base_labels = {label for _, label in base}
                labels = base_labels | {rule.label for _, _, rule in places}
                rows.append(
                    {
                        "n_words": int(first[k + 1] - first[k]),
                        "n_base": len(base),
                        "first_word": int(words.min()) if len(words) else None,
                        "last_word": int(words.max()) if len(words) else None,
                        "base_labels": ",".join(sorted(base_labels)),
                        "labels": ",".join(sorted(labels)),
                        "score": max([0.0, BASE_CONFIDENCE if base else 0.0, *(CONFIDENCE[r.priority] for _, _, r in places)]),
                        "spans": [{"label": r.label, "start": a, "end": b, "priority": r.priority} for a, b, r in places],
                    }
                )
            table = pa.RecordBatch.from_pylist(rows, _SCHEMA)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *table.columns], ["doc_id", *_SCHEMA.names])

    spans = "array<struct<label: string, start: long, end: long, priority: int>>"
    return scan(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        work,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        f"score double, spans {spans}",
    )


_SCHEMA = pa.schema(
    [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("priority", pa.int32())]))),
    ]
)
