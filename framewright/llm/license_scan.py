"""Licence recognition by sentence rules, in DataFrame operations only.

Texts are cut at stops into blocks of lines, the lines normalised (A-Z in lower case, everything but letters and digits one blank,
comment words at their start left out).  A known licence sentence is found where it fills one line or several lines that follow
each other, so wrapped headers behind comment signs are found too; empty lines end a sentence.  What is left of a text is its ordered sequence of sentence identifiers.
Licence rules are sequences too; they are tried in order, the more specific first, and each match uses its identifiers up.

The known sentences and rules are a fixed list of this module and part of the plan.  Texts meet by the
SHA-256 of their content.  Defined results: null and empty texts have no sentences; repeated rows get equal answers; identifiers
that no rule uses are counted as unmatched; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import stored
from framewright.llm.decontaminate import lowered

#: Ends of blocks: stops before blanks or the end.
ENDS = r"[.!?;:]+[\x20\x09-\x0D]+|[.!?;:]+\z"
#: Words that start a comment line.
COMMENT = r"(?<![^\n\r])[\x20\t]*(?:rem|dnl)(?![a-z0-9])"

#: Known licence sentences, normalised, by identifier.
SENTENCES = {
    "apache-grant": "licensed under the apache license version 2 0",
    "apache-file": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
    "on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-terms": "see the license for the specific language governing permissions and limitations under the license",
    "mit-grant": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the rights to use "
    "copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the "
    "software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the software",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "gpl-3": "this work is licensed under the gnu general public license version 3",
    "gpl-2": "this work is licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software",
    "gpl-3-later": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
    "free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "bsd-conditions": "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-name": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission",
    "all-rights": "all rights reserved",
}
#: Licences by their sequences of sentences; an earlier rule wins.
RULES = (
    ("BSD-3-Clause", ("bsd-conditions", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-conditions", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-grant", "apache-file", "apache-copy", "apache-basis", "apache-terms")),
    ("Apache-2.0", ("apache-grant", "apache-file")),
    ("MIT", ("mit-permission", "mit-notice")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-later", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-3-later")),
    ("Apache-2.0", ("apache-grant",)),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-licensed",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("GPL-3.0-only", ("gpl-3",)),
    ("GPL-2.0-only", ("gpl-2",)),
    ("all-rights-reserved", ("all-rights",)),
)
#: Other wordings of known sentences; ``*`` stands for one to twelve words.
VARIANTS = (
    ("apache-grant", "licensed under the apache license version 2 0 the license"),
    ("bsd-name", "neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this "
     "software without specific prior written permission"),
    ("bsd-name", "neither the name of * nor the names of other contributors may be used to endorse or promote products derived from "
     "this software without specific prior written permission"),
    ("gpl-2-later", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
     "free software foundation either version 2 of the license or at your option any later version"),
)
#: Rules of sentences that only the variants have; they come after the others.
MORE_RULES = (("GPL-2.0-or-later", ("gpl-free", "gpl-2-later", "gpl-hope")), ("GPL-2.0-or-later", ("gpl-free", "gpl-2-later")))


def normalised(block: Column) -> Column:
    """Lines of letters and digits with single blanks between; an empty line stays empty."""
    lines = F.regexp_replace(F.regexp_replace(lowered(block), COMMENT, " "), r"[^a-z0-9\n\r]+", " ")
    return F.trim(F.regexp_replace(lines, r" ?(?:\r\n|\n|\r) ?", "\n"))


def _pattern(sentence: str) -> str:
    words = [r"[a-z0-9]+(?:[ \n][a-z0-9]+){0,11}" if w == "*" else w for w in sentence.split(" ")]
    return r"[ \n]".join(words)


def _wordings() -> list[tuple[str, str]]:
    """Identifier and pattern of each wording, the longest first."""
    every = sorted([*SENTENCES.items(), *VARIANTS], key=lambda x: -len(x[1]))
    return [(i, _pattern(s)) for i, s in every]


def sequence_of(ids: tuple[str, ...]) -> str:
    return "".join(f"<{i}>" for i in ids)


def matched(sequence: Column) -> Column:
    """The sequence with every rule's match replaced by ``[licence]``, in order of the rules."""
    for licence, ids in (*RULES, *MORE_RULES):
        sequence = F.replace(sequence, F.lit(sequence_of(ids)), F.lit(f"[{licence}]"))
    return sequence


def licences(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_sentences`` (known ones), ``sequence`` (their identifiers), ``licenses`` (comma-joined, in
    order of the text), ``n_unmatched`` (identifiers that no rule used)."""
    wordings = _wordings()
    known = rf"(?<![^\n])({'|'.join(p for _, p in wordings)})(?![^\n])"
    named = F.coalesce(*[F.when(F.col("said").rlike(rf"\A(?:{p})\z"), F.lit(i)) for i, p in wordings])
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_id", F.unhex(F.sha2("text", 256)))
    cut = texts.select("text_id", F.posexplode(F.split("text", ENDS, -1)).alias("block", "raw"))
    said = cut.select("text_id", "block", F.posexplode(F.regexp_extract_all(normalised(F.col("raw")), F.lit(known), 1)).alias("line", "said"))
    hits = said.select("text_id", F.struct("block", "line").alias("pos"), named.alias("id")).distinct()
    by_text = hits.groupBy("text_id").agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("found"))
    tagged = F.transform(F.col("found.id"), lambda i: F.concat(F.lit("<"), i, F.lit(">")))
    by_text = by_text.select("text_id", F.size("found").cast("long").alias("n_sentences"), F.array_join(tagged, "").alias("sequence"))
    by_text = by_text.withColumn("marked", matched(F.col("sequence"))).select(
        "text_id", "n_sentences", "sequence",
        F.array_join(F.regexp_extract_all("marked", F.lit(r"\[([^\]]+)\]"), 1), ",").alias("licenses"),
        F.size(F.regexp_extract_all("marked", F.lit("<[^>]+>"), 0)).cast("long").alias("n_unmatched"),
    )
    found = stored(by_text, "licence-sequences")
    return texts.select("doc_id", "text_id").join(found, "text_id", "left").select(
        "doc_id",
        F.coalesce("n_sentences", F.lit(0)).alias("n_sentences"),
        F.coalesce("sequence", F.lit("")).alias("sequence"),
        F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("n_unmatched", F.lit(0)).alias("n_unmatched"),
    )
