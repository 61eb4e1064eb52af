"""Licence recognition by sentences, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind

#: Normalised sentences of public licences and notices, with their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "APACHE-NOTICE",
    "you may not use this file except in compliance with the license": "APACHE-COMPLIANCE",
    "licensed under the apache license version 2 0 the license": "APACHE-NOTICE",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "APACHE-COPY",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "APACHE-COPY",
    "you may obtain a copy of the license at": "APACHE-COPY",
    "released under the mit license": "MIT-NOTICE",
    "licensed under the mit license": "MIT-NOTICE",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MIT-GRANT",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "MIT-GRANT",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MIT-CONDITION",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MIT-WARRANTY",
    "the software is provided as is without warranty of any kind": "MIT-WARRANTY",
    "this work is licensed under the gnu general public license version 3": "GPL3-NOTICE",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3-GRANT",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2-GRANT",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "GPL-GRANT",
    "licensed under the gnu lesser general public license version 3": "LGPL3-NOTICE",
    "licensed under cc by 4 0": "CCBY-NOTICE",
    "licensed under cc by sa 4 0": "CCBYSA-NOTICE",
    "licensed under cc by nc 4 0": "CCBYNC-NOTICE",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSD-GRANT",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSD-SOURCE",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSD-BINARY",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSD-ENDORSE",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISC-GRANT",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISC-GRANT",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "ISC-GRANT",
    "this is free and unencumbered software released into the public domain": "UNLICENSE-GRANT",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "MPL2-NOTICE",
}
#: Licence rules, tried in this order: the sentences a licence shows, in order.
RULES = (
    ("BSD-3-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-ENDORSE")),
    ("BSD-2-Clause", ("BSD-GRANT", "BSD-SOURCE", "BSD-BINARY")),
    ("MIT", ("MIT-GRANT", "MIT-CONDITION", "MIT-WARRANTY")),
    ("MIT", ("MIT-GRANT",)),
    ("MIT", ("MIT-NOTICE",)),
    ("Apache-2.0", ("APACHE-NOTICE", "APACHE-COMPLIANCE", "APACHE-COPY")),
    ("Apache-2.0", ("APACHE-NOTICE",)),
    ("GPL-3.0", ("GPL3-NOTICE",)),
    ("GPL-3.0", ("GPL3-GRANT",)),
    ("GPL-2.0", ("GPL2-GRANT",)),
    ("GPL", ("GPL-GRANT",)),
    ("LGPL-3.0", ("LGPL3-NOTICE",)),
    ("CC-BY-4.0", ("CCBY-NOTICE",)),
    ("CC-BY-SA-4.0", ("CCBYSA-NOTICE",)),
    ("CC-BY-NC-4.0", ("CCBYNC-NOTICE",)),
    ("ISC", ("ISC-GRANT",)),
    ("Unlicense", ("UNLICENSE-GRANT",)),
    ("MPL-2.0", ("MPL2-NOTICE",)),
)
#: Every known sentence holds one of these, wrapped or not; texts without them aren't looked at.
CUES = r"(?i)licen[sc]e|redistribut|permission|unencumbered|warranty"
#: Where a sentence may begin or end: a mark followed by white space, or a line feed.
SENTENCE_END = r"[.!?;:]+(?:[ \t\r]+|$|(?=\n))|\n"
#: A sentence longer than this is none of those known.
LONGEST = max(map(len, SENTENCES)) * 4
#: Any known sentence between two such places, the longest that fits. Places within it don't
#: count: wrapped lines are joined, and marks as in "v. 2.0" or "free software:" end nothing.
KNOWN = (
    r"(?:(?<=\| )|^)(?:"
    + "|".join(s.replace(" ", r"\|? ") for s in sorted(SENTENCES, key=len, reverse=True))
    + r")(?=\||$)"
)


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order.

    Normalised: lower case, runs of anything but letters a-z and digits become one space, so
    that line prefixes of comments, quotes and parentheses don't matter; a bar before the space
    marks where a sentence may begin or end.
    """
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    marked = F.regexp_replace(F.translate(F.lower(text), "|", " "), SENTENCE_END, "|")
    marked = F.regexp_replace(F.regexp_replace(marked, "[^a-z0-9|]+", " "), r" ?\|[ |]*", "| ")
    found = F.regexp_extract_all(F.btrim(marked, F.lit(" ")), F.lit(KNOWN), F.lit(0))
    ids = F.transform(found, lambda s: F.element_at(known, F.translate(s, "|", "")))
    return F.when(text.rlike(CUES), ids).otherwise(F.array().cast("array<string>"))


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    rules: Sequence[tuple[str, Sequence[str]]] = RULES,
) -> DataFrame:
    """``doc_id, sentence_ids, licenses`` of every row.

    The identifier sequence is matched against the rules in order; a rule takes all runs of its
    sentences out of the sequence (others may stand between them only as unknown sentences), so
    a shorter rule doesn't match what a longer one explains. ``licenses`` has each licence once,
    in rule order. A null or empty text has none; rows are judged alone, so repeated rows give
    equal rows; ids pass through as they are; other columns are not read.
    """
    rows = bind(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("_text")),
        {"sentence_ids": sentence_ids(F.coalesce(F.col("_text"), F.lit("")))},
    ).drop("_text")
    whole = F.concat(F.lit(" "), F.array_join("sentence_ids", "  "), F.lit(" "))
    start = F.struct(whole.alias("rest"), F.array().cast("array<string>").alias("licenses"))
    table = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit("".join(f" {x} " for x in ids)).alias("run"))
        for name, ids in rules
    ])
    apply = lambda s, r: F.struct(
        F.replace(s["rest"], r["run"], F.lit(" ")).alias("rest"),
        F.when(F.contains(s["rest"], r["run"]), F.array_append(s["licenses"], r["name"]))
        .otherwise(s["licenses"]).alias("licenses"),
    )
    judged = F.when(F.size("sentence_ids") > 0, F.array_distinct(F.aggregate(table, start, apply, lambda s: s["licenses"])))
    return rows.select(
        "doc_id", "sentence_ids", F.coalesce(judged, F.array().cast("array<string>")).alias("licenses")
    )
