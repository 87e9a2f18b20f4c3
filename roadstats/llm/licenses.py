"""License scans by an exact set-similarity join, as Spark expressions only.

Text blocks are joined with license templates on word sets: a block matches a template if it
holds at least ``CONTAINMENT`` of the template's distinct words. The join is exact:

* A block is as many consecutive words as ``BLOCK`` or twice the template's words, whichever is
  more, and begins at any word of the text. Function words say nothing and are not among a
  template's words.
* Words are ordered by how many texts hold each (rarest first, over the whole table). A
  template of n words that needs a = ceil(n x CONTAINMENT) of them cannot match a text that
  lacks all of its first n - a + 1 words: only these prefix words are indexed.
* Length filter: the text holds at least a of the template vocabulary's words.
* Positional filter: from the first word they share on, in the global order, the text still holds
  at least a of them.
* The rest are verified by the most distinct template words that any block holds, from one sweep
  over the places of the template's words (``most_in_span``).

One pass over the texts writes a narrow table (counts, phrase places and the places of words of
the template vocabulary) to the shared folder; frequencies, candidates and verification read that.
The template vocabulary and its index are bounded by the templates given and are broadcast.

Beside the join, fixed phrases are located as consecutive words (``PHRASES``).

Defined results: a null or empty text has no words and no labels, score 0. Repeated rows each
get their row. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstats.llm.syncmers import _let, _span
from roadstats.session import new_work_dir

#: Phrases of the contract and their labels (fixed values).
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
FUNCTION_WORDS = frozenset("a an and any are be by for in is may not of or that the this to under with without".split())
#: Notices and license bodies by label; a block with most of a template's words carries it.
TEMPLATES = {
    "agpl-3.0": "gnu affero general public license",
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-4.0": "licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4.0": "cc by nc 4 0",
    "cc-by-sa-4.0": "cc by sa 4 0",
    "cc0-1.0": "creative commons cc0 1 0 universal public domain dedication",
    "confidential": "this document is confidential and may not be distributed without permission",
    "gpl-3.0": "licensed under the gnu general public license version 3",
    "lgpl-3.0": "gnu lesser general public license",
    "mit": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "bsd-2-text": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "mpl-2.0": "subject to the terms of the mozilla public license version 2 0",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
        an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "gpl-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
        License for more details. You should have received a copy of the GNU General Public License along with this program.
        If not, see <https://www.gnu.org/licenses/>.""",
}
#: The parts that follow the texts above in the whole licenses.
_MIT_WARRANTY = """The Software is provided "as is", without warranty of any kind, express or implied, including but not limited to
    the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or
    copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise,
    arising from, out of or in connection with the Software or the use or other dealings in the Software."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission."""
_BSD_WARRANTY = """This software is provided by the copyright holders and contributors "as is" and any express or implied
    warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose
    are disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental,
    special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services;
    loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in
    contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software,
    even if advised of the possibility of such damage."""
_ISC_WARRANTY = """In no event shall the author be liable for any special, direct, indirect, or consequential damages or any
    damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other
    tortious action, arising out of or in connection with the use or performance of this software."""
TEMPLATES |= {
    "bsd-2-body": f"{TEMPLATES['bsd-2-text']} {_BSD_WARRANTY}",
    "bsd-3-body": f"{TEMPLATES['bsd-2-text']} {_BSD_NAMES} {_BSD_WARRANTY}",
    "isc-body": f"{TEMPLATES['isc-text']} {_ISC_WARRANTY}",
    "mit-body": f"{TEMPLATES['mit-text']} {_MIT_WARRANTY}",
}
CONTAINMENT = 0.85
#: Fewest words of a block, and words from one block's begin to the next.
BLOCK, STEP = 32, 1
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_pieces(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.replace("\u212a", "\u0138").lower()) if w]


def template_words(text: str) -> list[str]:
    return sorted(set(template_pieces(text)) - FUNCTION_WORDS)


def span_of(text: str) -> int:
    """Words of a block that is compared with a template."""
    return max(BLOCK, 2 * len(template_pieces(text)))


def lowered(text: Column) -> Column:
    """Lower case that changes no other word into an ASCII one: the Kelvin sign, the only other
    character that lower-cases to an ASCII letter alone, is put out of the way."""
    return F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u0138")))


def pieces_of(low: Column) -> Column:
    """Words (digits, letters and other non-ASCII characters) of a lower-cased text; an empty
    piece stands before a leading and after a trailing separator."""
    return F.split(low, SEPARATORS)


def phrase_places(low: Column, pieces: Column, phrases: list[str]) -> Column:
    """Where a phrase's words stand consecutively: array<struct<phrase, at>>."""
    parts = [p.split(" ") for p in phrases]
    lead = (pieces[0] == "").cast("int")

    def starts(n: int, part: list[str]) -> Column:
        here = lambda i: _all([pieces[i + j] == w for j, w in enumerate(part)])
        found = F.filter(_span(F.size(pieces) - len(part)), here)
        return F.transform(found, lambda i: F.struct(F.lit(n).alias("phrase"), (i - lead).alias("at")))

    none = F.array().cast("array<struct<phrase:int,at:int>>")
    # Words are only compared in texts that contain each of the phrase's words.
    return F.concat(*[F.when(_all([low.contains(w) for w in part]), starts(n, part)).otherwise(none) for n, part in enumerate(parts)])


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def tokens_of(pieces: Column, vocabulary: list[str], least: int) -> Column:
    """Words of the vocabulary in a text: array<bigint> of number in the vocabulary (from 1) << 32 |
    place; empty for texts with fewer than ``least`` distinct ones (the length filter of every template)."""
    known = F.array(*map(F.lit, vocabulary))
    token = lambda w, i: F.shiftleft(F.array_position(known, w), 32).bitwiseOR(i.cast("bigint"))
    found = F.filter(F.transform(pieces, lambda w, i: F.when(w.isin(vocabulary), token(w, i))), lambda t: t.isNotNull())
    some = F.size(F.array_intersect(pieces, known)) >= least
    return F.when(some, found).otherwise(F.array().cast("array<bigint>"))


def word_of(token: Column) -> Column:
    return F.shiftright(token, 32).cast("int")


def most_in_span(tokens: Column, span: Column) -> Column:
    """Most distinct words that ``span`` consecutive words of the text hold, among ``tokens``.

    Blocks that begin from max(place before of the same word + 1, place - span + 1) to its place count
    a token as their first of its word: the maximum of the running sum over those beginnings."""
    at = lambda t: t.bitwiseAND(F.lit((1 << 32) - 1))

    def events(ordered: Column) -> Column:
        def begin(t: Column, i: Column) -> Column:
            before = F.get(ordered, i - 1)
            again = F.when(word_of(before) == word_of(t), at(before) + 1)
            return F.greatest(at(t) - span + 1, again, F.lit(0)) * 2 + 1

        return F.sort_array(F.concat(F.transform(ordered, begin), F.transform(ordered, lambda t: at(t) * 2 + 2)))

    def step(so_far: Column, event: Column) -> Column:
        now = so_far["now"] + F.when(event % 2 == 1, 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(so_far["most"], now).alias("most"))

    none = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    return F.aggregate(_let(F.sort_array(tokens), events), none, step, lambda x: x["most"])


def needed(size: int, containment: float) -> int:
    """Words that a block must share with a template of ``size`` words."""
    return math.ceil(size * containment - 1e-9)


def scan(docs: DataFrame, id_col: str, text_col: str, vocabulary: list[str], least: int, phrases: list[str]) -> DataFrame:
    """The narrow table: doc_id, text_key, n_words, places and tokens of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))

    def facts(low: Column, pieces: Column) -> Column:
        edges = (pieces[0] == "").cast("int") + ((F.element_at(pieces, -1) == "") & (F.size(pieces) > 1)).cast("int")
        return F.struct(
            (F.size(pieces) - edges).cast("bigint").alias("n_words"),
            phrase_places(low, pieces, phrases).alias("places"),
            tokens_of(pieces, vocabulary, least).alias("tokens"),
        )

    found = _let(lowered(F.col("text")), lambda low: _let(pieces_of(low), lambda pieces: facts(low, pieces)))
    return rows.select("doc_id", "text_key", found.alias("facts")).select("doc_id", "text_key", "facts.*")


def own_words(scanned: DataFrame) -> DataFrame:
    """(doc_id, text_key, tokens, own): each text with words of the vocabulary once, and which."""
    texts = scanned.where(F.size("tokens") > 0).select("doc_id", "text_key", "tokens").dropDuplicates(["doc_id", "text_key"])
    return texts.withColumn("own", F.array_distinct(F.transform("tokens", word_of)))


def global_order(texts: DataFrame, size: int) -> list[int]:
    """Numbers of the vocabulary's ``size`` words, that of the fewest texts first. They bound what
    comes to the driver."""
    counted = texts.select(F.explode("own").alias("word")).groupBy("word").count()
    frequency = {r["word"]: r["count"] for r in counted.collect()}
    return sorted(range(1, size + 1), key=lambda w: (frequency.get(w, 0), w))


def candidates(texts: DataFrame, order: list[int], templates: list[list[int]], needs: list[int], positional: bool = True) -> DataFrame:
    """``texts`` with ``met``: the templates (numbers of words each) that pass every filter.

    Words stand by their place in the global order. The first word that a text shares with a
    template's prefix is the first one they share at all, if the template matches. So they share at
    most that word and the text's words behind it (the positional filter); the words behind it in the
    template are enough for any prefix word."""
    rank = {word: place for place, word in enumerate(order, 1)}
    index: dict[int, list[int]] = {}
    for n, (words, need) in enumerate(zip(templates, needs)):
        for place in sorted(rank[w] for w in words)[: len(words) - need + 1]:
            index.setdefault(place, []).append(n)
    ranks = F.array(*[F.lit(rank[w]) for w in range(1, len(order) + 1)])
    prefixes = F.array(*[F.array(*map(F.lit, index.get(place, []))).cast("array<int>") for place in range(1, len(order) + 1)])
    least = F.array(*map(F.lit, needs))

    def hits(own: Column) -> Column:
        """(template, room) of each shared prefix word, in the global order."""
        def of_word(place: Column, at: Column) -> Column:
            room = F.size(own) - (at if positional else F.lit(0))
            return F.transform(F.element_at(prefixes, place), lambda n: F.struct(n.alias("template"), room.alias("room")))

        return F.flatten(F.transform(own, of_word))

    def passing(found: Column, names: Column) -> Column:
        first = lambda h, at: F.array_position(names, h["template"]) == at + 1
        enough = lambda h: h["room"] >= F.get(least, h["template"])
        return F.transform(F.filter(found, lambda h, at: first(h, at) & enough(h)), lambda h: h["template"])

    ordered = F.sort_array(F.transform("own", lambda w: F.element_at(ranks, w)))
    met = _let(_let(ordered, hits), lambda found: _let(F.transform(found, lambda h: h["template"]), lambda names: passing(found, names)))
    return texts.withColumn("met", met).where(F.size("met") > 0)


def join_templates(scanned: DataFrame, templates: dict[str, str], vocabulary: list[str], containment: float) -> DataFrame:
    """(doc_id, text_key, label, contained): the best block of each label of each text."""
    spark, texts = scanned.sparkSession, own_words(scanned)
    number = {w: n for n, w in enumerate(vocabulary, 1)}
    words = [[number[w] for w in template_words(text)] for text in templates.values()]
    needs = [needed(len(w), containment) for w in words]
    members = [
        (word, n, label, len(words[n]), needs[n], span_of(text))
        for n, (label, text) in enumerate(templates.items()) for word in words[n]
    ]
    of_word = spark.createDataFrame(members, "word int, template int, label string, size int, need int, span int")
    met = candidates(texts, global_order(texts, len(vocabulary)), words, needs)
    tokens = met.select("doc_id", "text_key", "met", F.explode("tokens").alias("token"))
    pairs = tokens.withColumn("word", word_of(F.col("token"))).join(F.broadcast(of_word), "word")
    pairs = pairs.where(F.array_contains("met", F.col("template")))
    groups = pairs.groupBy("doc_id", "text_key", "label", "size", "need", "span").agg(F.collect_list("token").alias("tokens"))
    shared = groups.select("*", most_in_span(F.col("tokens"), F.col("span")).alias("shared")).where(F.col("shared") >= F.col("need"))
    return shared.select("doc_id", "text_key", "label", (F.col("shared") / F.col("size")).alias("contained"))


def find_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per document: doc_id, n_words, places of phrases, and found template labels
    (array<struct<label, contained>>)."""
    spark = docs.sparkSession
    root = new_work_dir(spark, "licenses")
    sets = [template_words(t) for t in templates.values()]
    least = min(needed(len(words), containment) for words in sets)
    vocabulary = sorted({w for words in sets for w in words})
    scan(docs, id_col, text_col, vocabulary, least, list(phrases)).write.parquet(root)
    scanned = spark.read.parquet(root)
    found = join_templates(scanned, templates, vocabulary, containment)
    by_text = found.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct("label", "contained"))).alias("found"))
    rows = scanned.select("doc_id", "text_key", "n_words", "places")
    on = rows["doc_id"].eqNullSafe(by_text["doc_id"]) & (rows["text_key"] == by_text["text_key"])
    none = F.array().cast("array<struct<label:string,contained:double>>")
    return rows.join(by_text, on, "left").select(rows["doc_id"], "n_words", "places", F.coalesce("found", none).alias("found"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "text")
    found = find_licenses(docs)
    at = F.transform("places", lambda p: p["at"])
    names = F.array(*map(F.lit, PHRASES.values()))
    base = F.array_distinct(F.transform("places", lambda p: names[p["phrase"]]))
    own = F.transform("found", lambda f: f["label"])
    best = F.coalesce(F.array_max(F.transform("found", lambda f: f["contained"])), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(at).cast("bigint").alias("first_word"),
        F.array_max(at).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
    )
