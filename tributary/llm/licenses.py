"""License scan by canonical digest: texts equal to a known licence after normalisation.

Normalisation takes out what may differ between copies of one licence: case, punctuation, list marks,
copyright lines, white space and equivalent spellings. Entire texts are compared, by a hash join of
digests: a document as a whole, each of its lines, and each run of as many blocks (between lines without
a letter or digit) as a known text has. Whole texts besides those below are files of ``license_texts``.
"""

from __future__ import annotations

from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.tables import Stage

#: Known digests that are broadcast at most; more are joined by shuffle. Known texts from which words are drawn that
#: tell where to look.
BROADCAST_ROWS, GATED = 200_000, 20_000

#: Equivalent spellings, the left one becomes the right one (fixed values).
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("sublicence", "sublicense"), ("organisation", "organization"), ("whilst", "while"),
    ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("modelled", "modeled"), ("noncommercial", "non commercial"), ("version", "v"), ("https", "http"),
)

#: Licence texts and notices (fixed values).
KNOWN = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "BSD-3-Clause-notice": "Released under the BSD 3-Clause License.",
}
#: Names that notices call a licence, by SPDX id (fixed values).
NAMES = {
    "MIT": ("MIT License", "MIT"), "ISC": ("ISC License", "ISC"), "Zlib": ("zlib License", "zlib"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "BSD-3-Clause"),
    **{f"{k}-{v}": (f"{name}, version {v[: -2] if v.endswith('.0') else v}", f"{name} v{v}", f"{name} version {v}", f"{k}v{v[: -2] if v.endswith('.0') else v}", f"{k}-{v}")
       for k, name, versions in (("GPL", "GNU General Public License", ("2.0", "3.0")), ("LGPL", "GNU Lesser General Public License", ("2.1", "3.0")),
                                 ("AGPL", "GNU Affero General Public License", ("3.0",))) for v in versions},
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0", "MPL-2.0"),
    "Unlicense": ("Unlicense",), "BSL-1.0": ("Boost Software License, Version 1.0", "BSL-1.0"), "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "CC0-1.0"),
    **{f"CC-{k}-4.0": (f"CC {k} 4.0", f"CC-{k}-4.0", f"Creative Commons {name} 4.0 International License", f"Creative Commons {name} 4.0 International")
       for k, name in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
                       ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))},
}
SENTENCES = tuple(
    f"{start}{what} under {a}{{}}" for start in ("", "This work is ", "This project is ", "This software is ", "This code is ", "This file is ")
    for what in ("licensed", "released", "distributed") for a in ("", "the ", "the terms of the ", "a ")
)


def all_known() -> list[tuple[str, str]]:
    """(license_id, text) of all known licences: whole texts, also without what follows their terms, and notices."""
    rows = list(KNOWN.items())
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        text, end = path.read_text(encoding="utf-8"), "END OF TERMS AND CONDITIONS"
        rows.append((path.stem, text))
        if end in text:
            terms = text[: text.index(end)]
            rows += [(path.stem, terms), (path.stem, terms + end)]
        if path.stem.startswith("BSD"):
            rows.append((path.stem, "All rights reserved.\n\n" + text))
    for name, ids in NAMES.items():
        rows += [(f"{name}-notice", sentence.format(x)) for x in ids for sentence in SENTENCES]
        own = [name, f"{name}-only", f"{name}-or-later"] if "GPL" in name else [name]
        rows += [(f"{name}-notice", f"SPDX-License-Identifier: {x}") for x in own]
    return rows


def canonical(text: Column) -> Column:
    """Canonical form; null stays null. A text of nothing but copyright lines and marks is empty."""
    lower = F.lower(text)
    lines = F.regexp_replace(lower, r"(?m)^[^\p{L}\p{N}\n]*(?:copyright\b|\(c\)|©)[^\n]*$", " ")
    marks = F.regexp_replace(lines, r"(?m)^[\x20\t]*(?:[0-9]{1,2}|[a-z])[.)][\x20\t]", " ")
    plain = F.concat(F.lit(" "), F.regexp_replace(marks, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    known = plain.rlike(" (?:" + "|".join(a for a, _ in SPELLINGS) + ") ")
    spelt = plain
    for other, usual in SPELLINGS:
        # Twice, since neighbours share the space between them.
        spelt = F.replace(F.replace(spelt, F.lit(f" {other} "), F.lit(f" {usual} ")), F.lit(f" {other} "), F.lit(f" {usual} "))
    return F.trim(F.when(known, spelt).otherwise(plain))


def blocks_of(text: Column) -> Column:
    """Canonical forms of the blocks between lines without a letter or digit, none of them empty; joined they are the canonical text."""
    return F.filter(F.transform(F.split(text, r"\n[^\p{L}\p{N}]*\n", -1), canonical), lambda x: x != "")


def gate_of(forms: list[list[str]]) -> str | None:
    """A pattern that every text with one of these canonical forms (words) matches in lower case.

    It has words of letters such that each form has one of them: the word in most forms first. A word
    that an equivalent spelling may stand for comes with it. None if a form has no such word.
    """
    spelt = {}
    for other, usual in SPELLINGS:
        spelt.setdefault(usual, []).append(other)
    left, words = [{w for w in form if w.isascii() and w.isalpha() and len(w) > 3} for form in forms], []
    while left:
        counts = Counter(w for form in left for w in form)
        if not counts or not all(left):
            return None
        word = max(counts, key=lambda w: (counts[w], len(w), w))
        words += [word, *spelt.get(word, ())]
        left = [form for form in left if word not in form]
    return "|".join(words) if words else None


def known_licenses(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """(license_id, text)."""
    return spark.createDataFrame(sorted(texts.items() if texts else all_known()), "license_id string, text string")


def find_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per distinct (id, text): id, ``copies``, ``digest`` of the whole text, ``license_id`` if that is
    a known one, ``line_licenses`` (ids of licences that are whole lines, in order of name),
    ``n_license_lines`` (different lines, not repeats) and ``block_licenses`` (ids of licences that are runs of whole blocks, in order of name).

    ``known`` has (license_id, text); of licences with one canonical form the first by name counts,
    those with an empty form are left out. Null and empty texts match nothing. Rows without an id
    count as one id. Other columns are not carried along.
    """
    stage = Stage(docs.sparkSession)
    forms = stage.table(known.select("license_id", canonical(F.col("text")).alias("c")).where("license_id is not null and c <> ''"), "forms")
    digests = stage.table(forms.groupBy(F.sha2("c", 256).alias("unit")).agg(F.min("license_id").alias("license_id")), "digests")
    n = forms.count()
    gate = gate_of([r[0] for r in forms.select(F.array_distinct(F.split("c", " "))).collect()]) if 0 < n <= GATED else None
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t"))

    def may_be(text: Column) -> Column:
        """False only for what is no known text and holds none."""
        return F.lower(text).rlike(gate) if gate else F.lit(True)

    whole = F.sha2(canonical(F.col("t")), 256)
    lines = F.filter(F.split("t", "\n", -1), lambda x: (F.length(x) >= 3) & x.rlike(r"\p{L}") & may_be(x))
    lines = F.when(may_be(F.col("t")), lines).otherwise(F.expr("cast(array() as array<string>)"))
    units = source.select("id", whole.alias("digest"), F.array_union(F.array(F.lit(None).cast("string")), lines).alias("units"))
    units = units.select("id", "digest", F.posexplode_outer("units").alias("place", "line"))
    units = units.withColumn("unit", F.when(F.col("place") == 0, F.col("digest")).otherwise(F.sha2(canonical(F.col("line")), 256)))
    joined = units.select("id", "digest", "place", "unit").join(F.broadcast(digests) if n <= BROADCAST_ROWS else digests, "unit", "left")
    joined = joined.select("id", "digest", "place", "license_id")
    joined = joined.union(_in_blocks(source.where(may_be(F.col("t"))), known, stage, n <= BROADCAST_ROWS))
    line = F.when(F.col("place") > 0, F.col("license_id"))
    return joined.groupBy("id", "digest").agg(
        F.count_if(F.col("place") == 0).alias("copies"), F.max(F.when(F.col("place") == 0, F.col("license_id"))).alias("license_id"),
        F.array_join(F.sort_array(F.collect_set(line)), ",").alias("line_licenses"), F.count(line).alias("n_license_lines"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("place") < 0, F.col("license_id")))), ",").alias("block_licenses"),
    ).withColumnRenamed("id", id_col)


def _in_blocks(source: DataFrame, known: DataFrame, stage: Stage, small: bool) -> DataFrame:
    """(id, digest, place -1, license_id) of known texts whose blocks follow one another in a text (id, t)."""
    texts = known.where("license_id is not null").select("license_id", blocks_of(F.col("text")).alias("b")).where("size(b) > 0")
    texts = texts.groupBy("b").agg(F.min("license_id").alias("license_id")).select("license_id", "b", F.size("b").alias("n"), F.sha2(F.array_join("b", "\n"), 256).alias("name"))
    parts = stage.table(texts.select("license_id", "n", "name", F.posexplode("b").alias("k", "c")).select("license_id", "n", "name", "k", F.sha2("c", 256).alias("unit")), "blocks")
    digest, raw = F.sha2(F.array_join("b", " "), 256).alias("digest"), F.xxhash64("t").alias("raw")
    units = source.select("id", raw, blocks_of(F.col("t")).alias("b")).select("id", "raw", digest, F.posexplode("b").alias("place", "c"))
    units = units.select("id", "raw", "digest", "place", F.sha2("c", 256).alias("unit"))
    hits = units.join(F.broadcast(parts) if small else parts, "unit").withColumn("start", F.col("place") - F.col("k"))
    # Copies of one text have the same blocks, so blocks are counted once.
    runs = hits.groupBy("id", "raw", "digest", "start", "name", "n", "license_id").agg(F.count_distinct("k").alias("found")).where("found = n")
    return runs.select("id", "digest", F.lit(-1).alias("place"), "license_id")
