"""Licence families of paragraphs by a trained classifier, confirmed against templates.

Paragraphs end at a line of no more than white space and comment signs, and at a line that ends a sentence, so
hard-wrapped lines belong together and a line between others stands alone; the lines of a longer paragraph are
looked at too, and it is licensed if its whole or a line is, by the families of all of them. Word 1- to 3-grams, hashed to sparse vectors, feed a multinomial logistic regression
whose classes are the families and "unknown". It is trained on the templates, on variants of them with
words left out or added, and on a bounded sample of the corpus' own lines as the unknown class. An
isotonic fit on other variants and lines turns the probability of any family into a calibrated one; below
one half a paragraph is unknown. A known paragraph is confirmed if enough of the word pairs of one of its
family's templates occur in it, or enough of its own in such a template. Only DataFrame functions and ``pyspark.ml`` on the JVM are used.

Odd input: null and empty texts have no paragraphs and no licence; rows of a repeated id share the sums of all
of them; rows without an id are taken as one id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.session import materialize

# Licence families and phrases by which texts announce them
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "Apache License, Version 2.0, January 2004",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "MIT License",
        "The MIT License (MIT)",
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "GNU General Public License, Version 3, 29 June 2007",
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation",
    ),
    "bsd": (
        "BSD 3-Clause License",
        "BSD 2-Clause License",
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "public-domain": (
        "This work is in the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0 Universal.",
    ),
    "proprietary": ("All rights reserved.", "Copyright. All rights reserved.", "All rights reserved. Unauthorised copying is prohibited."),
}
FAMILIES = list(TEMPLATES)
BUCKETS = 1 << 14
#: Corpus lines that train the unknown class, at most; chosen by a hash of the line.
UNKNOWN_LINES = 4_000
VARIANTS = 24
CONFIRM = 0.7
# Signs of a comment's blank line; where a paragraph ends: blank lines, a line break behind a sentence
SIGNS = r"\n\t#*/;%-"
BREAK = r"\n(?:[\s#*/;%-]*\n|(?<=[.!?:;…。！？][\"'”’»)\]]{0,2}[ \t]{0,4}\n))"
# Fixed value: what ends a line, next to \n
OTHER_BREAKS = r"\r\x0b\f\x85\u2028\u2029"
#: Word pairs that a part of a template shares with it, at least.
PART_PAIRS = 4


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _paragraphs(text: Column) -> Column:
    """The paragraphs of a text, with the line breaks inside them."""
    text = F.coalesce(text, F.lit(""))
    # most texts have no other line break than \n
    other = text.rlike(f"[{OTHER_BREAKS}]")
    parts = F.split(F.when(other, F.regexp_replace(text, r"\R", "\n")).otherwise(text), BREAK)
    return F.filter(parts, lambda x: x.rlike(f"[^ {SIGNS}]"))


def paragraphs(documents: DataFrame) -> DataFrame:
    """(doc_id, row, at, line): each paragraph as a whole, and its lines if it has several."""
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text")
    whole = own.select("doc_id", "row", F.posexplode(_paragraphs(F.col("text"))).alias("at", "whole"))
    return whole.select("doc_id", "row", "at", F.explode(_lines(F.col("whole"))).alias("line"))


def _lines(whole: Column) -> Column:
    """A paragraph as a whole, and its lines if it has several."""
    several = F.filter(F.split(whole, "\n"), lambda x: F.trim(x) != "")
    return F.when(F.contains(whole, F.lit("\n")) & (F.size(several) > 1), F.concat(F.array(whole), several)).otherwise(F.array(whole))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _drawn(doc_id: Column, line: Column, share: float) -> Column:
    return F.pmod(F.xxhash64(doc_id, line), F.lit(1 << 20)) < int(share * (1 << 20)) + 1


def looked(documents: DataFrame, unknown: int) -> DataFrame:
    """(doc_id, n_paragraphs, n_lines, some) per row, in one pass: ``some`` are at least the lines drawn as ``unknown``
    of all lines are."""
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # a row with a letter has a line, so there are as many lines at least
    least = own.where(F.col("text").rlike(r"[\p{L}\p{N}]")).count()
    share = min(1.0, unknown / max(least, 1))

    def of(parts: Column) -> Column:
        return _let(
            F.flatten(F.transform(parts, _lines)),
            lambda lines: F.struct(
                F.size(parts).cast("long").alias("n_paragraphs"),
                F.size(lines).cast("long").alias("n_lines"),
                F.filter(lines, lambda x: _drawn(F.col("doc_id"), x, share)).alias("some"),
            ),
        )

    found = own.select("doc_id", _let(_paragraphs(F.col("text")), of).alias("found"))
    return materialize(found, "licence_counts").select("doc_id", "found.*")


def templates(spark: SparkSession) -> DataFrame:
    """(family, label, text), a few rows."""
    rows = [F.struct(F.lit(f).alias("family"), F.lit(float(k + 1)).alias("label"), F.lit(t).alias("text")) for k, f in enumerate(FAMILIES) for t in TEMPLATES[f]]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _vectors(df: DataFrame) -> DataFrame:
    """Adds ``features`` for the word list ``words``."""
    def longer(grams: str, n: int) -> Column:  # the grams of n words, from those of one word less
        few = F.greatest(F.size("words") - (n - 1), F.lit(0))
        return F.zip_with(F.slice(grams, 1, few), F.slice("words", n, few), lambda a, b: F.concat(a, F.lit(" "), b))

    df = df.withColumn("two", longer("words", 2))
    df = df.withColumn("three", longer("two", 3))
    hashed = HashingTF(inputCol="grams", outputCol="features", numFeatures=BUCKETS, binary=True)
    return hashed.transform(df.withColumn("grams", F.concat("words", "two", "three"))).drop("grams", "two", "three")


class Classifier:
    """A fitted model; index 0 is the unknown class. ``rows`` has the counts of each row of the documents."""

    def __init__(self, documents: DataFrame, unknown: int = UNKNOWN_LINES):
        spark = documents.sparkSession
        # variants: a seventh of the words left out, some with words of no licence around them
        drawn = lambda *x: F.pmod(F.xxhash64(*x), F.lit(7)) == 0
        known = templates(spark).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
        kept = F.filter(_words(F.col("text")), lambda w: (F.col("v") < 6) | ~drawn(F.lit("drop"), "v", w))
        around = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.lower(F.hex(F.xxhash64(F.lit("word"), "v", "text", i))))
        known = known.withColumn("words", F.when(F.col("v") % 2 == 1, F.concat(kept, around)).otherwise(kept))
        self.rows = looked(documents, unknown)
        total = self.rows.agg(F.sum("n_lines")).first()[0] or 0
        share = min(1.0, unknown / max(total, 1))
        # single lines are drawn, so a line that repeats is not drawn by its content alone; the words of those few are looked at
        some = self.rows.select("doc_id", F.explode("some").alias("line")).where(_drawn(F.col("doc_id"), F.col("line"), share))
        # a line near a template would be no unknown one; words that the templates hold keep it out
        some = some.where(~F.lower("line").rlike(r"licen[cs]e|copyright|public domain|rights reserved|spdx|cc by|warrant|redistribution|hereby granted|liable for any|notice shall"))
        other = some.select(
            F.lit(0.0).alias("label"), _words(F.col("line")).alias("words"), F.pmod(F.xxhash64("line"), F.lit(4)).alias("v")
        )
        rows = known.select("label", "words", (F.col("v") % 4).cast("long").alias("v")).unionByName(other)
        # an empty corpus still needs an unknown class
        rows = rows.unionByName(known.select(F.lit(0.0).alias("label"), around.alias("words"), (F.col("v") % 4).cast("long").alias("v")))
        rows = materialize(_vectors(rows).select("label", "features", "v"), "licence_rows").coalesce(2)
        self.model = LogisticRegression(maxIter=40, regParam=0.002, family="multinomial").fit(rows.where("v <> 3"))
        held = self._any(rows.where("v = 3")).select("any", (F.col("label") > 0).cast("double").alias("label"))
        self.calibration = IsotonicRegression(featuresCol="any", labelCol="label").fit(held)

    def _any(self, rows: DataFrame) -> DataFrame:
        scored = self.model.transform(rows).withColumn("p", vector_to_array("probability"))
        scored = scored.withColumn("any", 1 - F.col("p")[0]).drop("prediction", "rawPrediction", "probability", "features")
        best = F.array_max(F.slice("p", 2, len(FAMILIES)))
        return scored.withColumn("best", (F.array_position(F.slice("p", 2, len(FAMILIES)), best) - 1).cast("int")).drop("p")

    def known(self, lines: DataFrame) -> DataFrame:
        """(doc_id, row, at, words, family, probability) of the lines of ``paragraphs`` that are of a family."""
        lines = lines.select("doc_id", "row", "at", _words(F.col("line")).alias("words"))
        scored = self.calibration.transform(self._any(_vectors(lines)))
        # a numbered row is filtered where it stands: pushed down, the filter would work out words, vector and
        # probabilities of each line again, once for every use
        scored = scored.withColumn("line_id", F.monotonically_increasing_id())
        family = F.element_at(F.array(*map(F.lit, FAMILIES)), F.col("best") + 1)
        found = scored.where("prediction >= 0.5 AND line_id >= 0")
        return found.select("doc_id", "row", "at", "words", family.alias("family"), F.col("prediction").alias("probability"))


def _pairs(df: DataFrame) -> DataFrame:
    """Adds ``pairs``, the different word pairs of ``words``."""
    two = NGram(n=2, inputCol="words", outputCol="pairs").transform(df)
    return two.withColumn("pairs", F.array_distinct("pairs"))


def _near(pairs: Column, wanted: Column) -> Column:
    """The larger of: the share of a template's pairs in the text, and the share of the text's pairs in a template."""

    def share(w: Column) -> Column:
        both = F.size(F.array_intersect(pairs, w))
        part = F.when(both >= PART_PAIRS, both / F.size(pairs)).otherwise(0.0)
        return F.greatest(both / F.size(w), part)

    return F.array_max(F.transform(wanted, share))


def confirmed(known: DataFrame) -> DataFrame:
    """Adds ``confirmed``: the words hold most word pairs of a template of their family, or are a part of it."""
    wanted = _pairs(templates(known.sparkSession).withColumn("words", _words(F.col("text"))))
    # as many rows as there are templates
    wanted = wanted.groupBy("family").agg(F.collect_list("pairs").alias("wanted"))
    met = _pairs(known).join(F.broadcast(wanted), "family")
    return met.withColumn("confirmed", _near(F.col("pairs"), F.col("wanted")) >= CONFIRM).drop("wanted", "pairs")


def scan(documents: DataFrame) -> DataFrame:
    """(doc_id, n_paragraphs, n_licensed, n_confirmed, families) per row of ``documents``."""
    # written once: what follows reads the few known lines, not the scores again
    classifier = Classifier(documents)
    found = confirmed(materialize(classifier.known(paragraphs(documents)), "licence_lines"))
    place = F.struct("row", "at")
    per_doc = found.groupBy("doc_id").agg(
        F.count_distinct(place).alias("n_licensed"),
        F.count_distinct(F.when(F.col("confirmed"), place)).alias("n_confirmed"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"),
    )
    own = classifier.rows.select("doc_id", "n_paragraphs")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = own.join(per_doc, own["doc_id"].eqNullSafe(per_doc["doc_id"]), "left").drop(per_doc["doc_id"])
    return out.select("doc_id", "n_paragraphs", zero("n_licensed"), zero("n_confirmed"), F.coalesce("families", F.lit("")).alias("families"))
