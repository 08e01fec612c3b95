"""Licence scan: sparse TF-IDF cosine to templates, then inheritance down the directory tree.

DataFrame functions only. Templates are short notices and whole licence texts, cut
into sentences. Every sentence of every file is compared with every sentence of the
templates; words weigh by their inverse document frequency over all files. Lines are
compared as they stand, and sentences also over line breaks (a blank or bare comment
line ends one), so wrapped text and comment blocks match. A sentence whose cosine to
a template reaches ``THRESHOLD`` gives its file that licence (the closest one
counts). A file that is nothing but licence text (``FILE_SHARE`` of its words) is a
licence file: of several licences that which explains most of its words is its own,
and licenses its directory. A file without a licence of its own takes that of the
nearest directory above.

Candidates: by the Cauchy-Schwarz inequality a sentence can only reach the
threshold if it holds one of the template's heaviest words, those without which
the shared weight stays too small. These anchors decide, without loss, which
files are split into sentences. By the same inequality a sentence is out, before any
shuffle, if its known words hold too little of its own weight or of any template's.
Templates and anchors are fixed texts of this module; their number does not grow with
the data.

Defined results: null texts and paths count as empty; without any licence
``license`` is null and ``origin`` is none; equal cosines go to the first
licence in alphabetical order; rows that repeat a path are files of their own;
an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import flag_possible, staged, text_or_empty

THRESHOLD = 0.7
FILE_SHARE = 0.8

# The usual short notices and first sentences of licences.
TEMPLATES = {
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License."],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met:",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under the Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": ["Released under CC0 1.0 Universal, no rights reserved."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."],
    "Proprietary": ["All rights reserved."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}

# Whole texts of licences, and the notices that files under longer ones carry.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE'
    " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
    " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
    " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
    " disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following"
    " disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission.\n\n"
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,'
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;"
    " LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN"
    " CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS"
    " SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
BODIES = {
    "MIT": (
        "MIT License\n\n"
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation the'
        " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
        " persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        f" Software.\n\n{_AS_IS}"
    ),
    "BSD-2-Clause": f"BSD 2-Clause License\n\n{_BSD_TERMS}{_BSD_END}",
    "BSD-3-Clause": f"BSD 3-Clause License\n\n{_BSD_TERMS}{_BSD_NAMES}{_BSD_END}",
    "ISC": (
        "ISC License\n\n"
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL'
        " IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,"
        " INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN"
        " ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF"
        " THIS SOFTWARE."
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with'
        " the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\n"
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        ' "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the'
        " specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
        " version.\n\n"
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied"
        " warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.\n\n"
        "You should have received a copy of the GNU General Public License along with this program. If not, see"
        " <https://www.gnu.org/licenses/>."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}

_WORD = r"[^a-z0-9.]+"  # what parts words; a full stop stays inside version numbers
_SENTENCE = r"\n|(?<=[.!?:;])\s"  # in a line
_JOINED = r"(?<=[.!?])\s+|\n[^A-Za-z0-9\n]*\n"  # over lines
SENTENCES = {
    name: [x for x in (*TEMPLATES.get(name, ()), *re.split(_JOINED, BODIES.get(name, "")))] for name in sorted({*TEMPLATES, *BODIES})
}


def plain_words(sentence: str) -> list[str]:
    found = (w.strip(".") for w in re.split(_WORD, sentence.lower()))
    return [w for w in found if w]


def words_of(text: Column) -> Column:
    """Words of a sentence: lower case, without the full stops around them."""
    spaced = F.regexp_replace(F.lower(text), r"(?<![a-z0-9])\.+|\.+(?![a-z0-9])", " ")
    return F.array_remove(F.split(spaced, _WORD), "")


def template_sentences() -> list[tuple[str, list[str]]]:
    """(licence, words) of every sentence of the templates; shorter ones than two words tell nothing."""
    rows = [(name, plain_words(x)) for name, sentences in SENTENCES.items() for x in sentences]
    return [(name, words) for name, words in rows if len(words) > 1]


def vocabulary() -> list[str]:
    return sorted({w for _, words in template_sentences() for w in words})


def known_words(files: DataFrame) -> DataFrame:
    """Per file its number of words and which template words it has; staged, the only pass over all texts."""
    known = F.array(*[F.lit(w) for w in vocabulary()])
    words = files.select("file", F.explode(F.array(words_of(F.col("text")))).alias("words"))
    found = words.select("file", F.size("words").alias("file_words"), F.array_intersect("words", known).alias("known"))
    return staged(found, "licence-known")


def frequencies(found: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of files, and for each template word in how many it occurs."""
    # The count of files travels as the word that no text has.
    rows = found.select(F.explode(F.concat("known", F.array(F.lit("")))).alias("word"))
    counted = {r.word: r.n for r in rows.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return counted.pop("", 0), counted


def anchors(weights: list[dict[str, float]]) -> list[str]:
    """Of every template the heaviest words, until those left can no longer carry the threshold."""
    found = set()
    for weight in weights:
        norm = sum(w * w for w in weight.values())
        left = norm
        for word in sorted(weight, key=lambda w: (-weight[w], w)):
            if left < THRESHOLD * THRESHOLD * norm * (1 - 1e-9):
                break
            found.add(word)
            left -= weight[word] ** 2
    return sorted(found)


def possible(words: Column, idf: dict[str, float], unseen: float, rows: list[tuple[str, str, int, float]]) -> Column:
    """False only for sentences that cannot reach the threshold with any template.

    The cosine is at most the root of the part of the sentence's squared weight that its known words hold, times the
    root of a template's squared shares of these words; unknown words count as if they all differed.
    """
    most: dict[str, float] = {}  # the largest squared share of a word in any template
    for word, _, _, share in rows:
        most[word] = max(most.get(word, 0.0), share * share)
    names = sorted(most)
    table = lambda values: F.create_map(*[F.lit(x) for w in names for x in (w, float(values[w]))])
    shares, squares = table(most), table({w: idf[w] ** 2 for w in names})
    least = (THRESHOLD - 1e-6) ** 2
    known = F.array_intersect(words, F.array(*[F.lit(w) for w in names]))
    zero = F.lit(0.0)
    shared = F.aggregate(known, zero, lambda sum_, w: sum_ + F.element_at(shares, w))

    def weigh(sums: Column, w: Column) -> Column:
        n = F.size(F.filter(words, lambda x: x == w)).cast("double")
        return F.struct((sums["weight"] + n * n * F.element_at(squares, w)).alias("weight"), (sums["n"] + n).alias("n"))

    def within(sums: Column) -> Column:
        others = (F.size(words) - sums["n"]) * F.lit(unseen**2)
        return sums["weight"] * F.least(F.lit(1.0), shared) >= F.lit(least) * (sums["weight"] + others)

    return (shared >= least) & F.aggregate(known, F.struct(zero.alias("weight"), zero.alias("n")), weigh, within)


def own_licenses(files: DataFrame) -> DataFrame:
    """(file, license, similarity, share): files with a sentence close to a template.

    ``files`` has file (a key: path and mark), text; ``share`` is the part of the file's words in such sentences.
    """
    spark = files.sparkSession
    found = known_words(files)
    total, counted = frequencies(found)
    idf = {w: math.log((total + 1) / (counted.get(w, 0) + 1)) + 1 for w in vocabulary()}
    unseen = math.log(total + 1) + 1
    rows, weights = [], []
    for license_id, words in template_sentences():
        weight = {w: n * idf[w] for w, n in Counter(words).items()}
        norm = math.sqrt(sum(w * w for w in weight.values()))
        weights.append(weight)
        rows += [(w, license_id, len(weights), weight[w] / norm) for w in weight]
    gate = F.array(*[F.lit(w) for w in anchors(weights)])
    templates = F.broadcast(spark.createDataFrame(rows, "word string, license string, template int, share double"))
    idfs = F.broadcast(spark.createDataFrame([*idf.items()], "word string, idf double"))

    keys = found.filter(F.arrays_overlap("known", gate)).select("file.path", "file.mark").distinct()
    flat = files.select("file.path", "file.mark", "text")
    # A file that the filter lets through without an anchor has no sentence with one either.
    gated = flag_possible(flat, staged(keys, "licence-gated"), ["path", "mark"], "_maybe").filter("_maybe")
    gated = gated.select(F.struct("path", "mark").alias("file"), "text", F.explode(F.array(F.split("text", _JOINED))).alias("over"))
    # Lines as they stand, and sentences over lines; the share of a file is taken over the latter alone.
    joined = F.transform("over", lambda x: F.struct(F.lit(True).alias("joined"), x.alias("sentence")))
    single = F.transform(
        F.array_except(F.split("text", _SENTENCE), "over"),
        lambda x: F.struct(F.lit(False).alias("joined"), x.alias("sentence")),
    )
    sentences = gated.select("file", F.posexplode(F.concat(joined, single)).alias("place", "s"))
    sentences = sentences.select("file", "place", "s.joined", F.explode(F.array(words_of(F.col("s.sentence")))).alias("words"))
    near_enough = possible(F.col("words"), idf, unseen, rows)
    sentences = staged(sentences.filter(F.arrays_overlap("words", gate) & near_enough), "licence-possible")
    unit = ["file", "place", "joined", "n_words"]
    counted_words = (
        sentences.select(*unit[:-1], F.size("words").alias("n_words"), F.explode("words").alias("word"))
        .groupBy(*unit, "word")
        .agg(F.count("*").alias("n"))
        .join(idfs, "word", "left")
        .withColumn("weight", F.col("n") * F.coalesce("idf", F.lit(unseen)))
    )
    counted_words = staged(counted_words.drop("idf"), "licence-words")
    norms = counted_words.groupBy("file", "place").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    dots = (
        counted_words.join(templates, "word")
        .groupBy(*unit, "license", "template")
        .agg(F.sum(F.col("weight") * F.col("share")).alias("dot"))
    )
    near = (
        dots.join(norms, ["file", "place"])
        .withColumn("similarity", F.round(F.col("dot") / F.col("norm"), 6))
        .filter(F.col("similarity") >= THRESHOLD)
        .groupBy(*unit, "license")
        .agg(F.max("similarity").alias("similarity"))
    )
    near = staged(near, "licence-sentences")
    order = sorted(SENTENCES, reverse=True)  # of equal similarities the alphabetically first is the greatest
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("license"))
    best = F.max(F.struct("similarity", rank.alias("rank"), "license")).alias("best")
    by_file = near.groupBy("file").agg(best)
    explained = near.filter("joined").groupBy("file", "license").agg(
        F.sum(F.col("similarity") * F.col("n_words")).alias("explained"), F.max("similarity").alias("similarity")
    )
    most = F.max(F.struct("explained", rank.alias("rank"), "license", "similarity")).alias("most")
    covered = near.filter("joined").groupBy("file", "place").agg(F.max("n_words").alias("n_words"))
    covered = covered.groupBy("file").agg(F.sum("n_words").alias("matched"))
    whole = explained.groupBy("file").agg(most).join(covered, "file")
    judged = staged(by_file.join(whole, "file", "left"), "licence-judged").join(found.select("file", "file_words"), "file")
    judged = judged.withColumn("share", F.coalesce(F.col("matched") / F.col("file_words"), F.lit(0.0)))
    is_licence = F.col("share") >= FILE_SHARE
    return judged.select(
        "file",
        F.when(is_licence, F.col("most.license")).otherwise(F.col("best.license")).alias("license"),
        F.when(is_licence, F.col("most.similarity")).otherwise(F.col("best.similarity")).alias("similarity"),
        "share",
    )


def directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(path: Column) -> Column:
    """All directories above a path, the root as an empty text included."""
    parts = F.split(directory(path), "/")
    deeper = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    return F.array_distinct(F.concat(F.array(F.lit("")), deeper))


def scan(files: DataFrame, path_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: the carried columns as ``row``, path, license, similarity, origin (own, inherited, none), from_dir."""
    path = F.coalesce(F.col(path_col).cast("string"), F.lit(""))
    text = text_or_empty(text_col)
    # Rows that repeat path and text are one file for the scan and get the same result.
    key = F.struct(path.alias("path"), F.xxhash64(text).alias("mark"))
    rows = files.select(F.struct(*carry).alias("row") if carry else F.lit(None).alias("row"), key.alias("file"), text.alias("text"))
    own = staged(own_licenses(rows.select("file", "text").filter("text != ''")), "own-licences")
    own = own.dropDuplicates(["file"])
    marked = rows.select("row", "file").join(own, "file", "left")

    order = F.struct("similarity", F.col("file.path"), F.col("license"))
    dirs = (
        own.filter(F.col("share") >= FILE_SHARE)
        .groupBy(directory(F.col("file.path")).alias("dir"))
        .agg(F.max_by(F.struct("license", "similarity"), order).alias("given"))
    )
    dirs = staged(dirs, "licensed-directories")
    # Directories, not files, look for the licence above them: there are fewer.
    homes = rows.select(directory(F.col("file.path")).alias("home")).distinct()
    above = homes.select("home", F.explode(ancestors(F.concat("home", F.lit("/x")))).alias("dir"))
    nearest = above.join(dirs, "dir").groupBy("home").agg(F.max_by(F.struct("dir", "given"), F.length("dir")).alias("near"))
    nearest = staged(nearest, "inherited-licences")
    out = marked.withColumn("home", directory(F.col("file.path"))).join(nearest, "home", "left")
    has_own, has_near = F.col("license").isNotNull(), F.col("near").isNotNull()
    return out.select(
        "row",
        "file.path",
        F.coalesce("license", "near.given.license").alias("license"),
        F.coalesce("similarity", "near.given.similarity").alias("similarity"),
        F.when(has_own, "own").when(has_near, "inherited").otherwise("none").alias("origin"),
        F.when(~has_own & has_near, F.col("near.dir")).alias("from_dir"),
    )
