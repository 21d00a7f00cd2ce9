"""License scan by ordered signature rules.

A text becomes its lower-case words, joined by single spaces. Each rule is a regular expression over
that with a priority and keywords; a rule is tried only where one of them occurs, and keywords
are only looked for where a short word that they share, a gate, does, so most texts meet no
expression at all. Rules are the base phrases, the hand-written signatures of
:mod:`tilewright.llm.signatures`, and names of licences in common phrases. All places of all rules are detections, intervals of words. A
detection inside the interval of another one of the same or a higher priority is suppressed;
of equal ones the earlier rule's stays. Everything is built-in columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm.signatures import VERSION as _V
from tilewright.llm.signatures import signatures

# Phrases and labels of the base detections. They outrank all rules.
BASE = (
    ("under the mit license", "mit", "mit license"),
    ("apache license version 2", "apache-2", "apache license"),
    ("cc by nc", "cc-by-nc", "cc by nc"),
)

_CC = "(?:creative commons |cc )"
#: Label, expression of the name, keyword that every match contains.
FAMILIES = (
    ("mit", "(?:the )?mit license", "mit license"),
    ("mit", "expat license", "expat license"),
    ("apache-2", f"apache license{_V}2(?: 0)?", "apache license"),
    ("apache-1.1", f"apache (?:software )?license{_V}1 1", "apache"),
    ("gpl-3", f"(?:gnu )?general public license{_V}3(?: 0)?", "general public license"),
    ("gpl-2", f"(?:gnu )?general public license{_V}2(?: 0)?", "general public license"),
    ("gpl", "gnu (?:general public license|gpl)", "gnu g"),
    ("gpl-3", f"gpl(?:{_V})?3", "gpl"),
    ("gpl-2", f"gpl(?:{_V})?2", "gpl"),
    ("lgpl-3", f"(?:gnu )?lesser general public license{_V}3(?: 0)?", "lesser general public"),
    ("lgpl-2.1", f"(?:gnu )?lesser general public license{_V}2 1", "lesser general public"),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public license", "general public license"),
    ("lgpl-3", f"lgpl(?:{_V})?3(?: 0)?", "lgpl"),
    ("lgpl-2.1", f"lgpl(?:{_V})?2 1", "lgpl"),
    ("lgpl", f"lgpl(?:{_V}[23](?: [01])?)?", "lgpl"),
    ("agpl-3", f"(?:gnu )?affero general public license(?:{_V}3(?: 0)?)?", "affero general public"),
    ("agpl-3", f"agpl(?:(?:{_V})?3)?", "agpl"),
    ("gfdl", f"(?:gnu )?free documentation license(?:{_V}1 [123])?", "free documentation license"),
    ("mpl-2", f"mozilla public license(?:{_V}2(?: 0)?)?", "mozilla public license"),
    ("mpl-1.1", f"mozilla public license{_V}1 1", "mozilla public license"),
    ("epl-2", f"eclipse public license(?:{_V}2(?: 0)?)?", "eclipse public license"),
    ("epl-1", f"eclipse public license{_V}1(?: 0)?", "eclipse public license"),
    ("cddl-1", f"common development and distribution license(?:{_V}1(?: [01])?)?", "common development and"),
    ("cpl-1", f"common public license(?:{_V}1(?: 0)?)?", "common public license"),
    ("eupl", f"european union public licen[cs]e(?:{_V}1 [012])?", "european union public"),
    ("bsd-2", "(?:2|two) clause bsd(?: license)?|bsd (?:2|two) clause(?: license)?|simplified bsd license", "bsd"),
    ("bsd-3", "(?:3|three) clause bsd(?: license)?|bsd (?:3|three) clause(?: license)?|(?:new|modified|revised) bsd license", "bsd"),
    ("bsd-4", "(?:4|four) clause bsd(?: license)?|bsd (?:4|four) clause(?: license)?", "bsd"),
    ("bsd", "bsd (?:style )?license", "bsd"),
    ("isc", "isc license", "isc license"),
    ("zlib", "zlib(?: libpng)? license", "zlib"),
    ("bsl-1", f"boost software license(?:{_V}1(?: 0)?)?", "boost software license"),
    ("unlicense", "(?:the )?unlicense", "unlicense"),
    ("wtfpl", "wtfpl(?: license)?", "wtf"),
    ("wtfpl", "do what the fuck you want to public license", "what the fuck"),
    ("artistic-2", f"artistic license(?:{_V}2(?: 0)?)?", "artistic license"),
    ("postgresql", "postgresql licen[cs]e", "postgresql licen"),
    ("python-2", "(?:python software foundation|psf) license", "license"),
    ("ofl-1.1", f"(?:sil )?open font license(?:{_V}1 1)?", "open font license"),
    ("odbl-1", f"open (?:data commons )?(?:open )?database license(?:{_V}1(?: 0)?)?", "database license"),
    ("ms-pl", "microsoft public license", "microsoft public license"),
    ("ms-rl", "microsoft reciprocal license", "microsoft reciprocal"),
    ("bsl-1.1", f"business source license(?:{_V}1 1)?", "business source license"),
    ("sspl-1", f"server side public license(?:{_V}1)?", "server side public"),
    ("elastic-2", f"elastic license(?:{_V}2(?: 0)?)?", "elastic license"),
    ("cc0-1", "cc0(?: 1(?: 0)?)?|creative commons zero(?: 1(?: 0)?)?", "c"),
    ("cc-by-nc-nd", f"{_CC}(?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s)(?: [1234] 0)?", "c"),
    ("cc-by-nc-sa", f"{_CC}(?:by nc sa|attribution non ?commercial share ?alike)(?: [1234] 0)?", "c"),
    ("cc-by-nc", f"{_CC}(?:by nc|attribution non ?commercial)(?: [1234] 0)?", "c"),
    ("cc-by-nd", f"{_CC}(?:by nd|attribution no ?deriv(?:ative)?s)(?: [1234] 0)?", "c"),
    ("cc-by-sa", f"{_CC}(?:by sa|attribution share ?alike)(?: [1234] 0)?", "c"),
    ("cc-by", "(?:creative commons (?:by|attribution)(?: [1234] 0)?|cc (?:by|attribution) [1234] 0)", "c"),
    ("public-domain", "public domain", "public domain"),
)
# the family of names that start with an abbreviation: what must occur for any of them
_CC_WORDS = ("cc0", "cc by", "cc attribution", "creative commons")
#: Short words that many keywords hold; a keyword without any is looked for in every text.
GATES = (
    "licen", "gpl", "warrant", "redistribut", "permi", "copy", "public", "software", "gnu", "bsd", "apache", "commons",
    "cc by", "attribution", "mit ", "mpl", "exception", "creative", "under", "artistic", "cecill", "sspl", "ofl", "epl",
)

#: Priority, score and expression around a name. Longer evidence ranks higher.
FORMS = (
    (4, 0.95, "(?:licensed|released|distributed|published|available|provided|issued) under (?:the )?(?:terms of (?:the )?)?(?:{0})"),
    (4, 0.9, "(?:subject to|governed by|covered by|according to|in accordance with) (?:the )?(?:terms of (?:the )?)?(?:{0})"),
    (3, 0.85, "under (?:the )?(?:terms of (?:the )?)?(?:{0})"),
    (3, 0.85, "licen[cs]e(?: is)? (?:the )?(?:{0})"),
    (2, 0.8, "(?:{0})(?: (?:unported|international|only|or later|or any later version))"),
    (1, 0.6, "(?:{0})"),
)
#: Names of identifiers as they follow "SPDX-License-Identifier:".
_SPDX = {"mit": "mit", "apache-2": "apache 2 0", "gpl-3": "gpl 3 0", "gpl-2": "gpl 2 0", "lgpl-3": "lgpl 3 0",
         "agpl-3": "agpl 3 0", "mpl-2": "mpl 2 0", "bsd-2": "bsd 2 clause", "bsd-3": "bsd 3 clause", "isc": "isc"}

_TOP, _LEVELS = 5, 6


def rules() -> list[tuple[str, str, tuple[str, ...], int, float, bool]]:
    """``(label, expression, keywords, priority, score, base)`` in order.

    An expression starts with the space before its first word and ends before the space
    behind its last one.
    """
    out = [(label, f" {phrase}(?= )", (word,), _TOP, 1.0, True) for phrase, label, word in BASE]
    for label, name in _SPDX.items():
        out.append((label, f" spdx license identifier {name}(?: only| or later)?(?= )", ("spdx license",), 4, 1.0, False))
    for label, expression, words, priority, score in signatures():
        out.append((label, f" (?:{expression})(?= )", words, priority, score, False))
    for priority, score, form in FORMS:
        for label, name, word in FAMILIES:
            words = _CC_WORDS if word == "c" else (word,)
            out.append((label, f" {form.format(name)}(?= )", words, priority, score, False))
    return out


def gates() -> dict[str, list[str]]:
    """The keywords of all rules by the first gate that each holds, else by themselves."""
    out: dict[str, list[str]] = {}
    for word in dict.fromkeys(w for rule in rules() for w in rule[2]):
        out.setdefault(next((g for g in GATES if g in word), word), []).append(word)
    return out


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("bigint")


def _let(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def _places(text: Column, rule: Column) -> Column:
    """All places of a rule: the words before each match are counted along the pieces between them."""
    none = F.expr("cast(array() as array<struct<start:bigint,stop:bigint>>)")

    def add(done: Column, step: Column) -> Column:
        begin = done["at"] + step["before"]
        stop = begin + step["own"]
        place = F.struct(begin.alias("start"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.concat(done["found"], F.array(place)).alias("found"))

    def walk(pieces: Column) -> Column:
        matches = F.regexp_extract_all(text, rule["expression"], F.lit(0))
        steps = F.zip_with(
            F.slice(pieces, F.lit(1), F.size(pieces) - 1), matches,
            lambda p, m: F.struct(_spaces(p).alias("before"), _spaces(m).alias("own")),
        )
        start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("found"))
        return F.aggregate(steps, start, add, lambda done: done["found"])

    return _let(F.split(text, rule["expression"], -1), lambda p: F.when(F.size(p) > 1, walk(p)).otherwise(none))


def _unsuppressed(found: Column) -> Column:
    """Detections that no detection of the same or a higher priority contains.

    In order of start, longest first, then highest priority, a detection is contained when an
    earlier one ends no sooner; the furthest end per priority is enough to know that.
    """
    empty = F.expr(f"cast(array() as {_FOUND})")

    def add(done: Column, x: Column) -> Column:
        inside = F.exists(
            F.slice(done["ends"], x["priority"] + 1, F.lit(_LEVELS)), lambda end: end >= x["stop"]
        )
        ends = F.transform(
            done["ends"], lambda end, i: F.when(i == x["priority"], F.greatest(end, x["stop"])).otherwise(end)
        )
        kept = F.when(inside, done["kept"]).otherwise(F.concat(done["kept"], F.array(x)))
        return F.struct(kept.alias("kept"), ends.alias("ends"))

    start = F.struct(
        empty.alias("kept"), F.array_repeat(F.lit(-1).cast("bigint"), _LEVELS).alias("ends")
    )
    return F.aggregate(F.array_sort(found), start, add, lambda done: done["kept"])


_FOUND = "array<struct<start:bigint,back:bigint,rank:int,number:int,stop:bigint,priority:int,label:string,score:double,base:boolean>>"


def detect(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_words``, all ``detections`` and the ``kept`` ones, in word positions.

    Null and empty texts have no words and no detections. Columns of these names are replaced.
    Rows are looked at one by one, so repeated rows and null ids give rows of their own.
    """
    docs = docs.drop("n_words", "detections", "kept", "_text", "_hits")
    table = F.array(
        *[
            F.struct(
                F.lit(number).alias("number"), F.lit(label).alias("label"), F.lit(expression).alias("expression"),
                F.array(*map(F.lit, words)).alias("words"), F.lit(priority).alias("priority"), F.lit(score).alias("score"),
                F.lit(base).alias("base"),
            )
            for number, (label, expression, words, priority, score, base) in enumerate(rules())
        ]
    )
    keywords = F.array(
        *[
            F.struct(F.lit(gate).alias("gate"), F.array(*map(F.lit, words)).alias("words"))
            for gate, words in gates().items()
        ]
    )
    gaps = F.lit(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    joined = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), gaps, F.lit(" ")))
    texts = docs.withColumn("_text", joined)
    texts = texts.withColumn(
        "n_words", F.when(F.col("_text") == "", F.lit(0).cast("bigint")).otherwise(_spaces(F.col("_text")) + 1)
    )
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # lower() folds more letters than A-Z: keywords may be found in vain, never missed
    def occurring(low: Column) -> Column:
        opened = F.filter(keywords, lambda g: F.contains(low, g["gate"]))
        return F.flatten(F.transform(opened, lambda g: F.filter(g["words"], lambda k: F.contains(low, k))))

    hits = _let(F.lower("_text"), occurring)
    texts = texts.withColumn("_hits", hits)
    padded = F.concat(F.lit(" "), F.translate("_text", upper, lower), F.lit(" "))

    def of_rule(text: Column, rule: Column) -> Column:
        return F.transform(
            _places(text, rule),
            lambda p: F.struct(
                p["start"].alias("start"), (-p["stop"]).alias("back"), (-rule["priority"]).alias("rank"),
                rule["number"].alias("number"), p["stop"].alias("stop"), rule["priority"].alias("priority"),
                rule["label"].alias("label"), rule["score"].alias("score"), rule["base"].alias("base"),
            ),
        )

    tried = F.filter(table, lambda r: F.arrays_overlap(F.col("_hits"), r["words"]))
    found = _let(padded, lambda text: F.flatten(F.transform(tried, lambda r: of_rule(text, r))))
    none = F.expr(f"cast(array() as {_FOUND})")
    texts = texts.withColumn("detections", F.when(F.size("_hits") > 0, found).otherwise(none))
    kept = F.when(F.size("detections") > 0, _unsuppressed(F.col("detections"))).otherwise(none)
    return texts.withColumn("kept", kept).drop("_text", "_hits")


def _labels(found: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["label"]))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: words, base places and labels, all labels, and a score.

    The score is the highest of the detections kept, 0 without any.
    """
    found = detect(docs.select("doc_id", "text"))
    found = found.withColumn("base", F.filter("detections", lambda x: x["base"]))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["start"])).alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["start"])).alias("last_word"),
        _labels(F.col("base")).alias("base_labels"),
        _labels(F.concat("base", "kept")).alias("labels"),
        F.coalesce(F.array_max(F.transform("kept", lambda x: x["score"])), F.lit(0.0)).alias("score"),
    )
