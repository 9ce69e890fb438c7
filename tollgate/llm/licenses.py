"""License scan: ordered signature rules over whole texts, with DataFrame functions alone.

The rules are the signatures of ``license_texts``, written by hand from license texts, file headers and identifiers, and
below them names of licenses in the wordings in which texts speak of them.
A text is reduced to lower-cased words, single-spaced.  A rule is a regex on that form, a label, a
priority and a keyword; a rule runs on a document only if the document has the keyword.  A detection is
dropped if a detection of higher priority, or of the same priority that is longer or stems from an
earlier rule, contains its interval.
"""

from __future__ import annotations

from functools import reduce
from itertools import product
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import plain, texts
from .license_texts import signatures

#: The phrases and labels of the base detections, which no rule suppresses.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: (label, keyword, regex of the name, versions); a version's regex follows from its digits.
FAMILIES = [
    ("apache", "apache", r"apache(?: software)?(?: public)?(?: licen[cs]e)?", ("1.0", "1.1", "2.0")),
    ("gpl", "general public", r"(?:gnu )?general public licen[cs]e(?: gpl)?", ("1.0", "2.0", "3.0")),
    ("gpl", "gpl", r"(?:gnu )?gpl(?: licen[cs]e)?", ("1.0", "2.0", "3.0")),
    ("lgpl", "lesser general", r"(?:gnu )?lesser general public licen[cs]e(?: lgpl)?", ("2.1", "3.0")),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?: licen[cs]e)?", ("2.1", "3.0")),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e(?: agpl)?", ("1.0", "3.0")),
    ("agpl", "agpl", r"(?:gnu )?agpl(?: licen[cs]e)?", ("1.0", "3.0")),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[cs]e", ("1.1", "1.2", "1.3")),
    ("mpl", "mozilla", r"mozilla public licen[cs]e(?: mpl)?", ("1.0", "1.1", "2.0")),
    ("epl", "eclipse", r"eclipse public licen[cs]e(?: epl)?", ("1.0", "2.0")),
    ("cddl", "common development", r"common development and distribution licen[cs]e", ("1.0", "1.1")),
    ("eupl", "european union public", r"european union public licen[cs]e", ("1.0", "1.1", "1.2")),
    ("ofl", "open font", r"(?:sil )?open font licen[cs]e", ("1.0", "1.1")),
    ("osl", "open software", r"open software licen[cs]e", ("1.0", "2.0", "3.0")),
    ("afl", "academic free", r"academic free licen[cs]e", ("2.0", "2.1", "3.0")),
    ("artistic", "artistic", r"(?:perl )?artistic licen[cs]e", ("1.0", "2.0")),
    ("bsl", "boost", r"boost software licen[cs]e", ("1.0",)),
    ("busl", "business source", r"business source licen[cs]e", ("1.1",)),
    ("zpl", "zope", r"zope public licen[cs]e", ("2.0", "2.1")),
    ("php", "php", r"php licen[cs]e", ("3.0", "3.01")),
    ("psf", "python", r"python(?: software foundation)? licen[cs]e", ("2.0",)),
    ("odbl", "database", r"open (?:data commons )?(?:open )?database licen[cs]e", ("1.0",)),
    ("mit", "mit licen", r"(?:expat )?mit licen[cs]e", ()),
    ("isc", "isc licen", r"isc licen[cs]e", ()),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", ()),
    ("bsd-2", "bsd", r"(?:simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[cs]e)?", ()),
    ("bsd-3", "bsd", r"(?:new bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[cs]e)?", ()),
    ("bsd", "bsd", r"bsd licen[cs]e", ()),
    ("unlicense", "unlicense", r"(?:the )?unlicense", ()),
    ("wtfpl", "wtfpl", r"wtfpl", ()),
    ("cc0", "cc0", r"(?:creative commons )?cc0", ("1.0",)),
    ("public-domain", "public domain", r"public domain", ()),
    ("proprietary", "reserved", r"all rights reserved", ()),
    ("proprietary", "proprietary", r"proprietary and confidential", ()),
] + [
    ("cc-" + "-".join(parts), "cc by", rf"(?:creative commons )?cc {' '.join(parts)}", ("1.0", "2.0", "2.5", "3.0", "4.0"))
    for parts in (("by",), ("by", "sa"), ("by", "nc"), ("by", "nd"), ("by", "nc", "sa"), ("by", "nc", "nd"))
]

#: Words that nearly every regex holds.
BROAD = ("licen", "apache", "gpl", "bsd", "cc by", "cc0", "unlicense", "wtfpl", "public domain", "reserved", "proprietary", "this software", "permission")

#: How a text may speak of a license; the surest first.
WORDINGS = [
    ("notice", r"(?:(?:re)?licen[cs]ed|released|distributed|available|covered|published) (?:and distributed )?under (?:the )?(?:terms (?:and conditions )?of )?(?:the |an? )?{}"),
    ("terms", r"(?:subject to|governed by|in accordance with|terms of) (?:the )?(?:terms of )?(?:the |an? )?{}"),
    ("spdx", r"spdx licen[cs]e identifier {}"),
    ("name", r"{}"),
]
LATER = r" (?:or (?:\(?at your option\)? )?(?:any )?later(?: version)?|and later)"


def rules() -> list[tuple[int, str, int, str, str]]:
    """(order, label, priority 1-4, keyword, regex), in the order in which they take precedence."""
    found = [(label, priority, keyword, regex) for label, priority, keyword, regex in signatures()]
    for (label, keyword, name, versions), (kind, wording) in product(FAMILIES, WORDINGS):
        for version in (*versions, ""):
            short = version.removesuffix(".0")
            digits = " ".join(version.split(".")) if short == version else f"{short}(?: 0)?"
            spelled = name + (rf"(?: licen[cs]e)?(?: international| unported)?(?: version| v| ver)? v?{digits}" if version else "")
            full = label + (f"-{version}" if version else "")
            sure = 1 + (kind != "name") + 2 * bool(version)
            if version and label.endswith("gpl"):
                found.append((full + "-or-later", 4, keyword, wording.format(spelled) + LATER))
            found.append((full, sure, keyword, wording.format(spelled)))
    found.sort(key=lambda r: -r[1])
    return [(i, *r) for i, r in enumerate(found)]


#: Every regex holds one of these, so a text without any of them is left at that.
STEMS = (*BROAD, *sorted({k for *_, k, r in rules() if not any(s in r.replace("licen[cs]e", "license") for s in BROAD)}))


def rule_table(spark: SparkSession) -> DataFrame:
    """The rules and, with priority 0, the base phrases: a few hundred constant rows."""
    base = [(-1 - i, label, 0, phrase, phrase) for i, (phrase, label) in enumerate(PHRASES.items())]
    rows = [(o, label, p, k, rf"(?<= ){r}(?= )") for o, label, p, k, r in base + rules()]
    return spark.createDataFrame(rows, "rule int, label string, priority int, keyword string, pattern string")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document with its words, base places and labels of all surviving detections.

    A null or empty text has no words and no labels; see ``frames.texts`` for null and repeated ids.
    """
    spark = docs.sparkSession
    table = rule_table(spark)
    keywords = sorted({r[3] for r in rules()} | set(PHRASES))
    blank = texts(docs, id_col, text_col).select("id", plain(F.col("text")).alias("t")).select("id", F.trim("t").alias("t"))
    single = F.concat(F.lit(" "), F.regexp_replace("t", " +", " "), F.lit(" "))
    n_words = F.when(F.col("t") == "", 0).otherwise(F.size(F.split("t", " +"))).cast("long")
    gate = reduce(or_, [F.contains("norm", F.lit(stem)) for stem in STEMS])  # stems of two words need single blanks
    found = blank.select("id", n_words.alias("n_words"), single.alias("norm"))
    found = found.select("id", "n_words", F.when(gate, F.col("norm")).alias("norm"))
    # the empty keyword has no rule: its row stands for the document itself
    has = F.array_compact(F.array(F.lit(""), *[F.when(F.contains("norm", F.lit(k)), F.lit(k)) for k in keywords]))
    found = found.select("id", "n_words", "norm", F.explode(has).alias("keyword")).join(F.broadcast(table), "keyword", "left")
    hits = F.regexp_extract_all("norm", F.col("pattern"), F.lit(0))
    gaps = F.split("norm", F.col("pattern"), -1)
    both = F.when(F.rlike("norm", F.col("pattern")), F.arrays_zip(hits.alias("hit"), gaps.alias("gap")))
    found = found.select("id", "n_words", "keyword", "rule", "label", "priority", F.posexplode_outer(both).alias("at", "one"))
    found = found.where("keyword = '' or one.hit is not null")  # the last gap stands after the last hit
    found = found.withColumns({"hit": F.col("one.hit"), "gap": F.col("one.gap")}).drop("one").repartition("id")

    def blanks(c):
        return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))

    order = Window.partitionBy("id", "rule").orderBy("at")
    found = found.withColumn("end", F.sum(F.length("gap") + F.length("hit")).over(order))
    found = found.withColumn("start", F.col("end") - F.length("hit"))
    found = found.withColumn("word", F.sum(blanks(F.col("gap")) + blanks(F.col("hit"))).over(order) - blanks(F.col("hit")) - 1)
    before = Window.partitionBy("id").orderBy(F.col("start"), F.col("end").desc(), F.col("priority").desc(), "rule").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.lit(None).cast("long")
    for p in (1, 2, 3, 4):
        reach = F.when(F.col("priority") == p, F.max(F.when(F.col("priority") >= p, F.col("end"))).over(before)).otherwise(reach)
    found = found.withColumn("reach", reach)
    base = F.col("hit").isNotNull() & (F.col("priority") == 0)
    kept = F.col("hit").isNotNull() & (F.col("priority") > 0) & (F.col("reach").isNull() | (F.col("reach") < F.col("end")))

    def labels(cond):
        return F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("label")))), ",")

    return found.groupBy("id").agg(
        F.first("n_words").alias("n_words"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("word"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("word"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(base | kept).alias("labels"),
        F.coalesce(F.max(F.when(base, 0.5).when(kept, 0.5 + F.col("priority") / 8)), F.lit(0.0)).alias("score"),
        F.count(F.when(kept, 1)).alias("n_detections"),
    )
