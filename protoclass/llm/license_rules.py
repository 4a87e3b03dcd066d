"""Operator 10: license scans by ordered signature rules.

The base finds fixed phrases as consecutive words. The method runs several
hundred regular expressions: some written out by hand, the others made from
hand-written sentence forms and license names. Every rule has keywords of which
each of its matches holds one; a single pass of a keyword automaton over the
lower-cased text picks the rules that can match, and only those run. Detections
are taken strongest first (by priority, then length, then start); one that lies
inside another taken before is suppressed, found by the largest end among the
taken ones that start no later, so many detections cost n log n. What is left
gives labels and a score.

Defined results: null and empty texts have no words, places or labels and a
score of 0; of detections equal in span and priority the first rule's stays;
texts are scanned whole, whatever their length and number of detections;
repeated rows each get a row; an empty table gives no rows; only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from protoclass.llm.common import table

# The words of a text, and the base phrases with their labels.
PHRASES = {(b"cc", b"by"): "cc-by", (b"general", b"public", b"license"): "gpl", (b"all", b"rights", b"reserved"): "reserved"}
#: On UTF-8 bytes: A-Z to lower case; and all that is no word character (ASCII but letters and digits) to a blank.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in _LOWER)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern[str]
    keywords: tuple[str, ...]
    priority: int
    weight: float


# Hand-written names: label, how the name is written, keywords of which it always has one.
_NUMBER = r"(?:[,;]?\s*\(?(?:version|v\.?)?\s*\d(?:\.\d)*(?:\s+or\s+(?:any\s+)?later(?:\s+version)?)?\)?)?"
NAMES = [
    ("apache-2.0", r"apache(?:\s+software)?\s+licen[sc]e[,;]?\s*\(?(?:version|v\.?)?\s*2(?:\.0)?\)?", ("apache",)),
    ("apache", r"apache(?:\s+software)?\s+licen[sc]e", ("apache",)),
    ("mit", r"(?:mit|expat|x11)\s+licen[sc]e", ("licen",)),
    ("isc", r"isc\s+licen[sc]e", ("licen",)),
    ("bsd-2-clause", r"(?:(?:simplified|freebsd)\s+bsd|bsd[\s-]+2[\s-]clause|2[\s-]clause\s+bsd)(?:\s+licen[sc]e)?", ("bsd",)),
    ("bsd-3-clause", r"(?:(?:new|revised|modified)\s+bsd|bsd[\s-]+3[\s-]clause|3[\s-]clause\s+bsd)(?:\s+licen[sc]e)?", ("bsd",)),
    ("bsd", r"bsd(?:[\s-]+style)?\s+licen[sc]e", ("bsd",)),
    ("gpl-2.0", r"(?:gnu\s+)?(?:general\s+public\s+licen[sc]e|gpl)[,;]?\s*\(?(?:version|v\.?)?\s*2(?:\.0)?\)?(?:\s+or\s+(?:any\s+)?later(?:\s+version)?)?", ("licen", "gpl")),
    ("gpl-3.0", r"(?:gnu\s+)?(?:general\s+public\s+licen[sc]e|gpl)[,;]?\s*\(?(?:version|v\.?)?\s*3(?:\.0)?\)?(?:\s+or\s+(?:any\s+)?later(?:\s+version)?)?", ("licen", "gpl")),
    ("gpl", r"(?:gnu\s+(?:general\s+public\s+licen[sc]e|gpl)|general\s+public\s+licen[sc]e)", ("licen", "gpl")),
    ("lgpl", r"(?:gnu\s+)?(?:(?:lesser|library)\s+general\s+public\s+licen[sc]e|lgpl)" + _NUMBER, ("licen", "gpl")),
    ("agpl", r"(?:gnu\s+)?(?:affero\s+general\s+public\s+licen[sc]e|agpl)" + _NUMBER, ("licen", "gpl")),
    ("gfdl", r"(?:gnu\s+)?(?:free\s+documentation\s+licen[sc]e|gfdl)" + _NUMBER, ("licen", "gfdl")),
    ("mpl", r"(?:mozilla\s+public\s+licen[sc]e|mpl)" + _NUMBER, ("mozilla", "mpl")),
    ("epl", r"eclipse\s+public\s+licen[sc]e" + _NUMBER, ("eclipse",)),
    ("cddl", r"(?:common\s+development\s+and\s+distribution\s+licen[sc]e|cddl)" + _NUMBER, ("licen", "cddl")),
    ("eupl", r"(?:european\s+union\s+public\s+licen[sc]e|eupl)" + _NUMBER, ("licen", "eupl")),
    ("artistic", r"artistic\s+licen[sc]e" + _NUMBER, ("artistic",)),
    ("bsl-1.0", r"boost\s+software\s+licen[sc]e" + _NUMBER, ("boost",)),
    ("zlib", r"zlib(?:/libpng)?\s+licen[sc]e", ("zlib",)),
    ("unlicense", r"(?:the\s+)?unlicen[sc]e", ("unlicen",)),
    ("wtfpl", r"(?:do\s+what\s+the\s+fuck\s+you\s+want\s+to\s+public\s+licen[sc]e|wtfpl)", ("fuck", "wtfpl")),
    ("psf", r"python\s+software\s+foundation\s+licen[sc]e" + _NUMBER, ("foundation",)),
    ("php", r"php\s+licen[sc]e" + _NUMBER, ("php",)),
    ("ofl", r"(?:sil\s+)?open\s+font\s+licen[sc]e" + _NUMBER, ("licen",)),
    ("odbl", r"(?:open\s+database\s+licen[sc]e|odbl)" + _NUMBER, ("licen", "odbl")),
    ("cc0", r"(?:cc0|creative\s+commons\s+zero)(?:\s+\d\.\d)?(?:\s+universal)?", ("cc0", "creative")),
    ("cc-by-nc-sa", r"(?:cc|creative\s+commons)[\s-]+(?:by[\s-]+nc[\s-]+sa|attribution[\s-]+non-?commercial[\s-]+share-?alike)(?:\s+\d\.\d)?", ("cc", "creative")),
    ("cc-by-nc-nd", r"(?:cc|creative\s+commons)[\s-]+(?:by[\s-]+nc[\s-]+nd|attribution[\s-]+non-?commercial[\s-]+no-?deriv\w*)(?:\s+\d\.\d)?", ("cc", "creative")),
    ("cc-by-nc", r"(?:cc|creative\s+commons)[\s-]+(?:by[\s-]+nc|attribution[\s-]+non-?commercial)(?:\s+\d\.\d)?", ("cc", "creative")),
    ("cc-by-nd", r"(?:cc|creative\s+commons)[\s-]+(?:by[\s-]+nd|attribution[\s-]+no-?deriv\w*)(?:\s+\d\.\d)?", ("cc", "creative")),
    ("cc-by-sa", r"(?:cc|creative\s+commons)[\s-]+(?:by[\s-]+sa|attribution[\s-]+share-?alike)(?:\s+\d\.\d)?", ("cc", "creative")),
    ("cc-by", r"(?:cc[\s-]+by|creative\s+commons[\s-]+attribution)(?:\s+\d\.\d)?", ("cc", "creative")),
    ("cc", r"creative\s+commons(?:\s+licen[sc]e)?", ("creative",)),
    ("ms-pl", r"microsoft\s+public\s+licen[sc]e", ("microsoft",)),
    ("ms-rl", r"microsoft\s+reciprocal\s+licen[sc]e", ("microsoft",)),
    ("cecill", r"cecill(?:-[a-c])?" + _NUMBER, ("cecill",)),
    ("osl", r"open\s+software\s+licen[sc]e" + _NUMBER, ("licen",)),
    ("afl", r"academic\s+free\s+licen[sc]e" + _NUMBER, ("academic",)),
    ("cpl", r"common\s+public\s+licen[sc]e" + _NUMBER, ("licen",)),
    ("ipl", r"ibm\s+public\s+licen[sc]e" + _NUMBER, ("ibm",)),
    ("ncsa", r"university\s+of\s+illinois/ncsa\s+open\s+source\s+licen[sc]e", ("ncsa",)),
    ("openssl", r"openssl\s+licen[sc]e", ("openssl",)),
    ("vim", r"vim\s+licen[sc]e", ("licen",)),
    ("lppl", r"latex\s+project\s+public\s+licen[sc]e" + _NUMBER, ("latex",)),
    ("elastic", r"elastic\s+licen[sc]e" + _NUMBER, ("elastic",)),
    ("sspl", r"(?:server\s+side\s+public\s+licen[sc]e|sspl)" + _NUMBER, ("licen", "sspl")),
    ("busl", r"business\s+source\s+licen[sc]e" + _NUMBER, ("business",)),
    ("postgresql", r"postgresql\s+licen[sc]e", ("postgresql",)),
    ("blueoak", r"blue\s+oak\s+model\s+licen[sc]e" + _NUMBER, ("oak",)),
    ("0bsd", r"(?:zero[\s-]+clause\s+bsd|bsd\s+zero[\s-]+clause|0bsd)(?:\s+licen[sc]e)?", ("bsd",)),
    ("ogl", r"open\s+government\s+licen[sc]e" + _NUMBER, ("government",)),
    ("odc-by", r"open\s+data\s+commons\s+attribution\s+licen[sc]e" + _NUMBER, ("commons",)),
    ("pddl", r"(?:public\s+domain\s+dedication\s+and\s+licen[sc]e|pddl)" + _NUMBER, ("licen", "pddl")),
]
# Hand-written sentence forms; {} is the name. Priority, weight, form.
FORMS = [
    (60, 0.95, r"licensed\s+(?:to\s+you\s+)?under\s+(?:the\s+(?:terms\s+of\s+the\s+)?|a\s+)?{}"),
    (60, 0.95, r"released\s+under\s+(?:the\s+(?:terms\s+of\s+the\s+)?|a\s+)?{}"),
    (60, 0.95, r"(?:distributed|available|published|provided|shared)\s+under\s+(?:the\s+(?:terms\s+of\s+the\s+)?|a\s+)?{}"),
    (58, 0.95, r"(?:redistribute\s+it\s+and/or\s+modify\s+it|use\s+is\s+governed|governed)\s+(?:under|by)\s+the\s+(?:terms\s+of\s+the\s+)?{}"),
    (56, 0.9, r"(?:under|subject\s+to)\s+the\s+(?:terms\s+(?:and\s+conditions\s+)?of\s+the\s+)?{}"),
    (54, 0.9, r"licen[sc]e\s*[:=]\s*(?:the\s+)?{}"),
    (40, 0.7, r"(?<![a-z0-9]){}(?![a-z0-9])"),
]
# Hand-written rules of their own: label, priority, weight, pattern, keywords
# (single words, one of which is in every match, however it is wrapped).
SIGNATURES = [
    ("spdx", 90, 1.0, r"spdx-license-identifier:\s*\(?[a-z0-9.+-]+(?:\s+(?:and|or|with)\s+[a-z0-9.+-]+)*\)?", ("spdx",)),
    ("mit", 80, 1.0, r"permission\s+is\s+hereby\s+granted,\s+free\s+of\s+charge,\s+to\s+any\s+person\s+obtaining\s+a\s+copy", ("hereby",)),
    ("isc", 80, 1.0, r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software\s+for\s+any\s+purpose", ("permission",)),
    ("bsd", 80, 1.0, r"redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms", ("redistribution",)),
    ("bsd-3-clause", 81, 1.0, r"neither\s+the\s+name\s+of\s+(?:(?!\bneither\b|\bnor\b).)*\bnor\s+the\s+names\s+of\s+its\s+contributors", ("contributors",)),
    ("gpl", 78, 0.95, r"this\s+program\s+is\s+free\s+software[;:,]\s+you\s+can\s+redistribute\s+it", ("redistribute",)),
    ("unlicense", 78, 1.0, r"this\s+is\s+free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain", ("unencumbered",)),
    ("warranty", 50, 0.7, r"without\s+warrant(?:y|ies)\s+(?:or\s+conditions\s+)?of\s+any\s+kind", ("warrant",)),
    ("warranty", 50, 0.7, r"(?:the\s+software\s+is\s+)?provided\s+[\"'“”]?as\s+is[\"'“”]?", ("provided",)),
    ("warranty", 50, 0.6, r"in\s+no\s+event\s+shall\s+the\s+(?:authors|copyright\s+holders?)", ("event",)),
    ("copyright", 45, 0.6, r"copyright\s+(?:\(c\)|©|&copy;)?\s*(?:19|20)\d\d(?:\s*[-,–]\s*(?:19|20)?\d\d)*", ("copyright",)),
    ("copyright", 45, 0.6, r"(?:\(c\)|©)\s*(?:copyright\s+)?(?:19|20)\d\d(?:\s*[-,–]\s*(?:19|20)?\d\d)*", ("(c)", "©")),
    ("reserved", 44, 0.5, r"all\s+rights\s+(?:are\s+)?reserved", ("rights",)),
    ("reserved", 44, 0.5, r"(?:some|no)\s+rights\s+reserved", ("rights",)),
    ("reserved", 44, 0.5, r"(?:alle\s+rechte\s+vorbehalten|tous\s+droits\s+réservés|todos\s+los\s+derechos\s+reservados)", ("rechte", "droits", "derechos")),
    ("proprietary", 46, 0.6, r"(?:confidential\s+and\s+proprietary|proprietary\s+and\s+confidential|may\s+not\s+be\s+(?:copied|reproduced|redistributed))", ("proprietary", "copied", "reproduced", "redistributed")),
    ("public-domain", 48, 0.8, r"(?:in(?:to)?|to)\s+the\s+public\s+domain", ("domain",)),
    ("public-domain", 48, 0.8, r"public\s+domain\s+(?:dedication|mark)", ("domain",)),
    ("cc", 70, 0.95, r"creativecommons\.org/(?:licenses|publicdomain)/[a-z0-9/.+-]+", ("creativecommons.org",)),
    ("apache-2.0", 70, 0.95, r"(?:www\.)?apache\.org/licenses/license-2\.0", ("apache.org",)),
    ("gpl", 70, 0.95, r"(?:www\.)?gnu\.org/licenses/?[a-z0-9/.+-]*", ("gnu.org",)),
    ("mit", 70, 0.95, r"opensource\.org/licenses/mit", ("opensource.org",)),
    ("mit", 79, 1.0, r"the\s+above\s+copyright\s+notice\s+and\s+this\s+permission\s+notice\s+(?:\([a-z\s]+\)\s+)?shall\s+be\s+included\s+in\s+all\s+copies", ("copies",)),
    ("mit", 79, 0.9, r"without\s+limitation\s+the\s+rights\s+to\s+use,\s+copy,\s+modify,\s+merge", ("limitation",)),
    ("mit-0", 76, 0.9, r"mit\s+no\s+attribution", ("attribution",)),
    ("apache-2.0", 79, 0.95, r"you\s+may\s+not\s+use\s+this\s+file\s+except\s+in\s+compliance\s+with\s+the\s+licen[sc]e", ("compliance",)),
    ("apache-2.0", 79, 0.9, r"unless\s+required\s+by\s+applicable\s+law\s+or\s+agreed\s+to\s+in\s+writing", ("applicable",)),
    ("apache-2.0", 77, 0.9, r"licensed\s+to\s+the\s+apache\s+software\s+foundation", ("apache",)),
    ("bsd", 79, 0.9, r"redistributions\s+of\s+source\s+code\s+must\s+retain\s+the\s+above\s+copyright\s+notice", ("redistributions",)),
    ("bsd", 79, 0.9, r"redistributions\s+in\s+binary\s+form\s+must\s+reproduce\s+the\s+above\s+copyright\s+notice", ("redistributions",)),
    ("bsd-4-clause", 82, 1.0, r"all\s+advertising\s+materials\s+mentioning\s+features\s+or\s+use\s+of\s+this\s+software", ("advertising",)),
    ("gpl", 78, 0.95, r"this\s+program\s+is\s+distributed\s+in\s+the\s+hope\s+that\s+it\s+will\s+be\s+useful", ("hope",)),
    ("gpl", 77, 0.9, r"you\s+should\s+have\s+received\s+a\s+copy\s+of\s+the\s+gnu\s+general\s+public\s+licen[sc]e", ("received",)),
    ("lgpl", 78, 0.95, r"you\s+should\s+have\s+received\s+a\s+copy\s+of\s+the\s+gnu\s+(?:lesser|library)\s+general\s+public\s+licen[sc]e", ("received",)),
    ("agpl", 78, 0.95, r"you\s+should\s+have\s+received\s+a\s+copy\s+of\s+the\s+gnu\s+affero\s+general\s+public\s+licen[sc]e", ("received",)),
    ("gfdl", 78, 0.95, r"permission\s+is\s+granted\s+to\s+copy,\s+distribute\s+and/or\s+modify\s+this\s+document", ("permission",)),
    ("mpl", 79, 1.0, r"this\s+source\s+code\s+form\s+is\s+subject\s+to\s+the\s+terms\s+of\s+the\s+mozilla\s+public\s+licen[sc]e", ("mozilla",)),
    ("mpl", 70, 0.95, r"mozilla\.org/mpl/[a-z0-9/.+-]*", ("mozilla.org",)),
    ("epl", 79, 0.95, r"this\s+program\s+and\s+the\s+accompanying\s+materials\s+are\s+made\s+available\s+under", ("accompanying",)),
    ("epl", 70, 0.95, r"eclipse\.org/legal/[a-z0-9/.+-]*", ("eclipse.org",)),
    ("zlib", 79, 1.0, r"the\s+origin\s+of\s+this\s+software\s+must\s+not\s+be\s+misrepresented", ("misrepresented",)),
    ("zlib", 78, 0.9, r"altered\s+source\s+versions\s+must\s+be\s+plainly\s+marked\s+as\s+such", ("plainly",)),
    ("bsl-1.0", 79, 0.95, r"boost\.org/license_1_0\.txt", ("boost.org",)),
    ("wtfpl", 79, 1.0, r"you\s+just\s+do\s+what\s+the\s+fuck\s+you\s+want\s+to", ("fuck",)),
    ("ofl", 79, 0.95, r"this\s+font\s+software\s+is\s+licensed\s+under\s+the\s+sil\s+open\s+font\s+licen[sc]e", ("sil",)),
    ("ofl", 70, 0.95, r"scripts\.sil\.org/ofl", ("sil.org",)),
    ("cc0", 79, 1.0, r"has\s+waived\s+all\s+copyright\s+and\s+related\s+or\s+neighboring\s+rights", ("waived",)),
    ("cc", 74, 0.95, r"this\s+(?:work|article|document|material)\s+is\s+licensed\s+under\s+(?:a|the)\s+creative\s+commons", ("creative",)),
    ("public-domain", 74, 0.9, r"(?:i|we|the\s+authors?)\s+(?:hereby\s+)?(?:release|dedicate|place)s?\s+(?:this|the)\s+(?:work|software|code)\s+(?:in)?to\s+the\s+public\s+domain", ("domain",)),
    ("public-domain", 60, 0.8, r"no\s+known\s+copyright\s+restrictions", ("restrictions",)),
    ("isc", 79, 0.9, r"the\s+software\s+is\s+provided\s+[\"'“”]?as\s+is[\"'“”]?\s+and\s+the\s+author\s+disclaims\s+all\s+warranties", ("disclaims",)),
    ("warranty", 50, 0.7, r"(?:any|all)\s+express(?:ed)?\s+or\s+implied\s+warranties", ("warranties",)),
    ("warranty", 50, 0.7, r"warranties\s+of\s+merchantability(?:\s+and\s+fitness\s+for\s+a\s+particular\s+purpose)?", ("merchantability",)),
    ("warranty", 50, 0.6, r"liable\s+for\s+any\s+(?:claim|direct|indirect|damages)", ("liable",)),
    ("proprietary", 47, 0.7, r"(?:unauthori[sz]ed|any)\s+(?:copying|use|reproduction|distribution)\s+(?:of\s+[a-z\s]{1,40})?is\s+(?:strictly\s+)?prohibited", ("prohibited",)),
    ("proprietary", 47, 0.7, r"for\s+(?:personal|internal),?\s+(?:and\s+|or\s+)?non-?commercial\s+use\s+only", ("commercial",)),
    ("proprietary", 46, 0.6, r"(?:end[\s-]+user\s+licen[sc]e\s+agreement|eula)(?![a-z0-9])", ("licen", "eula")),
    ("proprietary", 46, 0.6, r"no\s+part\s+of\s+this\s+(?:publication|book|work|document)\s+may\s+be\s+(?:reproduced|copied|stored)", ("publication", "book", "work", "document")),
    ("copyright", 45, 0.6, r"(?:droits?\s+d['’]auteur|urheberrecht(?:lich\s+geschützt)?|derechos?\s+de\s+autor)", ("auteur", "urheberrecht", "autor")),
    ("government", 60, 0.8, r"(?:crown\s+copyright|work\s+of\s+the\s+(?:u\.?s\.?|united\s+states)\s+government)", ("crown", "government")),
    ("dual", 66, 0.9, r"dual[\s-]+licensed\s+under", ("licensed",)),
    ("patent", 50, 0.5, r"(?:royalty-?free,?\s+)?(?:irrevocable\s+)?patent\s+licen[sc]e", ("patent",)),
]


def _rules() -> list[Rule]:
    rules = [Rule(label, re.compile(pattern, re.S), keys, priority * 100, weight) for label, priority, weight, pattern, keys in SIGNATURES]
    for at, (label, name, keywords) in enumerate(NAMES):
        # A named license is also more specific than the names behind it.
        rules += [Rule(label, re.compile(form.format(f"(?:{name})")), keywords, priority * 100 - at, weight) for priority, weight, form in FORMS]
    return rules


RULES = _rules()


def _automaton() -> ahocorasick.Automaton:
    """From every keyword to the numbers of its rules."""
    of: dict[str, list[int]] = {}
    for i, rule in enumerate(RULES):
        for k in rule.keywords:
            of.setdefault(k, []).append(i)
    found = ahocorasick.Automaton()
    for k, numbers in of.items():
        found.add_word(k, (k, numbers))
    found.make_automaton()
    return found


_KEYWORDS = _automaton()


def picked(lower: str) -> list[Rule]:
    """The rules of which a keyword is in the text, in order."""
    present = {k: numbers for _, (k, numbers) in _KEYWORDS.iter(lower)}
    return [RULES[i] for i in sorted({i for numbers in present.values() for i in numbers})]


@dataclass(frozen=True)
class Detection:
    label: str
    start: int
    end: int
    priority: int
    weight: float


def strongest(found: list[Detection]) -> list[Detection]:
    """The detections that lie in no stronger one, by start."""
    starts = sorted({d.start for d in found})
    # Largest end of the taken detections that start no later, as a tree of prefix maxima.
    ends = [-1] * (len(starts) + 1)
    kept = []
    for d in sorted(found, key=lambda d: (-d.priority, d.start - d.end, d.start)):
        place = i = bisect_left(starts, d.start) + 1
        while i > 0 and ends[i] < d.end:
            i &= i - 1
        if i > 0:
            continue
        kept.append(d)
        while place < len(ends):
            ends[place] = max(ends[place], d.end)
            place += place & -place
    return sorted(kept, key=lambda d: (d.start, d.end))


def detections(lower: str) -> list[Detection]:
    """The rules' detections after containment suppression, by start."""
    return strongest([Detection(r.label, *m.span(), r.priority, r.weight) for r in picked(lower) for m in r.pattern.finditer(lower)])


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place of a base phrase."""
    out = []
    for phrase, label in PHRASES.items():
        at = -1
        while True:
            try:
                at = words.index(phrase[0], at + 1)
            except ValueError:
                break
            if tuple(words[at : at + len(phrase)]) == phrase:
                out.append((at, label))
    return sorted(out)


def scan(text: str | None) -> dict:
    # Every character beyond ASCII is a word character, so words can be cut on UTF-8 bytes.
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.translate(_SPACED).split()
    base = base_places(words)
    more = detections(data.translate(_LOWER).decode("utf-8", "surrogatepass"))
    miss = 1.0
    for d in more:
        miss *= 1 - d.weight
    for _ in base:
        miss *= 0.5
    labels = {label for _, label in base}
    return {"n_words": len(words), "n_base": len(base), "first_word": base[0][0] if base else None, "last_word": base[-1][0] if base else None,
            "base_labels": ",".join(sorted(labels)), "labels": ",".join(sorted(labels | {d.label for d in more})), "score": 1 - miss,
            "found": [{"label": d.label, "start": d.start, "end": d.end, "weight": d.weight} for d in more]}


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                     ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                     ("found", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("weight", pa.float64())])))])


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: the base columns, labels, score, and ``found``:
    the detections left, with their spans in code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [{"doc_id": i} | scan(t) for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
                                  "score double, found array<struct<label: string, start: bigint, end: bigint, weight: double>>")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("found")
