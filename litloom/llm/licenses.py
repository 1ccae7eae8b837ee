"""License scans by sentence rules.

Sentences, normalised to lower-case words, map to identifiers of known licence sentences; where a whole sentence is
unknown its lines are looked up. The identifiers of a text in order are matched against licence rules: from the
most specific on, a rule holds where its identifiers follow each other, and takes them.

DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litloom.llm.arrays import let, sums_before

# Known sentences in normal form, by identifier.
SENTENCES = {
    "mit.grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit.notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit.warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit.liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc.grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd.grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd.source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd.binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd.names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd.warranty": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "apache.header": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache.comply": "you may not use this file except in compliance with the license",
    "apache.basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache.permissions": "see the license for the specific language governing permissions and limitations under the license",
    "gpl2.grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl3.grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl.warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl.details": "see the gnu general public license for more details",
    "mpl2.header": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense.grant": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved under copyright law",
    "gpl2.only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl3.only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation",
    "lgpl21.grant": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl3.grant": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl.warranty": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl.details": "see the gnu lesser general public license for more details",
    "agpl3.grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl.details": "see the gnu affero general public license for more details",
    "epl2.header": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "bsl.grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    "zlib.warranty": "this software is provided as is without any express or implied warranty",
    "zlib.liability": "in no event will the authors be held liable for any damages arising from the use of this software",
    "zlib.grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "cc0.dedication": "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law including all related and neighboring rights to the extent allowed by law",
}
# Licences and their names in statements of one line.
NAMES = {
    "MIT": ("the mit license", "mit"),
    "Apache-2.0": ("the apache license version 2 0", "apache 2 0"),
    "BSD-2-Clause": ("the bsd 2 clause license", "bsd 2 clause"),
    "BSD-3-Clause": ("the bsd 3 clause license", "bsd 3 clause"),
    "GPL-2.0": ("the gnu general public license version 2", "gpl 2 0"),
    "GPL-3.0": ("the gnu general public license version 3", "gpl 3 0"),
    "LGPL-2.1": ("the gnu lesser general public license version 2 1", "lgpl 2 1"),
    "LGPL-3.0": ("the gnu lesser general public license version 3", "lgpl 3 0"),
    "AGPL-3.0": ("the gnu affero general public license version 3", "agpl 3 0"),
    "MPL-2.0": ("the mozilla public license version 2 0", "mpl 2 0"),
    "EPL-2.0": ("the eclipse public license version 2 0", "epl 2 0"),
    "BSL-1.0": ("the boost software license version 1 0", "bsl 1 0"),
    "Zlib": ("the zlib license", "zlib"),
    "ISC": ("the isc license", "isc"),
    "Unlicense": ("the unlicense", "unlicense"),
    "CC0-1.0": ("cc0 1 0", "cc0"),
    "CC-BY-4.0": ("cc by 4 0", "a creative commons attribution 4 0 international license"),
    "CC-BY-SA-4.0": ("cc by sa 4 0", "a creative commons attribution sharealike 4 0 international license"),
    "CC-BY-NC-4.0": ("cc by nc 4 0", "a creative commons attribution noncommercial 4 0 international license"),
    "CC-BY-ND-4.0": ("cc by nd 4 0", "a creative commons attribution noderivatives 4 0 international license"),
    "CC-BY-NC-SA-4.0": ("cc by nc sa 4 0", "a creative commons attribution noncommercial sharealike 4 0 international license"),
}
STATEMENTS = ("licensed under {}", "released under {}", "distributed under {}", "available under {}", "this work is licensed under {}", "this software is licensed under {}", "spdx license identifier {}")
# Licence rules as sequences of identifiers, the more specific first.
RULES = (
    ("MIT", ("mit.grant", "mit.notice", "mit.warranty", "mit.liability")),
    ("MIT", ("mit.grant", "mit.notice")),
    ("ISC", ("isc.grant",)),
    ("BSD-3-Clause", ("bsd.grant", "bsd.source", "bsd.binary", "bsd.names", "bsd.warranty")),
    ("BSD-3-Clause", ("bsd.grant", "bsd.source", "bsd.binary", "bsd.names")),
    ("BSD-2-Clause", ("bsd.grant", "bsd.source", "bsd.binary", "bsd.warranty")),
    ("BSD-2-Clause", ("bsd.grant", "bsd.source", "bsd.binary")),
    ("Apache-2.0", ("apache.header", "apache.basis", "apache.permissions")),
    ("Apache-2.0", ("apache.header",)),
    ("Apache-2.0", ("apache.comply", "apache.basis")),
    ("GPL-3.0-or-later", ("gpl3.grant", "gpl.warranty")),
    ("GPL-3.0-or-later", ("gpl3.grant",)),
    ("GPL-2.0-or-later", ("gpl2.grant", "gpl.warranty")),
    ("GPL-2.0-or-later", ("gpl2.grant",)),
    ("MPL-2.0", ("mpl2.header",)),
    ("Unlicense", ("unlicense.grant",)),
    ("GPL-3.0-only", ("gpl3.only", "gpl.warranty")),
    ("GPL-3.0-only", ("gpl3.only",)),
    ("GPL-2.0-only", ("gpl2.only", "gpl.warranty")),
    ("GPL-2.0-only", ("gpl2.only",)),
    ("LGPL-2.1-or-later", ("lgpl21.grant", "lgpl.warranty")),
    ("LGPL-2.1-or-later", ("lgpl21.grant",)),
    ("LGPL-3.0-or-later", ("lgpl3.grant", "lgpl.warranty")),
    ("LGPL-3.0-or-later", ("lgpl3.grant",)),
    ("AGPL-3.0-or-later", ("agpl3.grant", "gpl.warranty")),
    ("AGPL-3.0-or-later", ("agpl3.grant",)),
    ("EPL-2.0", ("epl2.header",)),
    ("BSL-1.0", ("bsl.grant",)),
    ("Zlib", ("zlib.warranty", "zlib.liability", "zlib.grant")),
    ("Zlib", ("zlib.liability", "zlib.grant")),
    ("CC0-1.0", ("cc0.dedication",)),
)
# Sentences that name a holder, with what stands for any name in normal form.
HOLDERS = (
    ("^neither the name of [a-z0-9 ]{1,80} nor the names of (?:its|their|any) contributors", "neither the name of the copyright holder nor the names of its contributors"),
    ("^this software is provided by [a-z0-9 ]{1,80} and (?:any )?contributors as is", "this software is provided by the copyright holders and contributors as is"),
)
#: Every known sentence matches this, so texts that don't have no known sentence.
HINT = r"(?i)licen[cs]|copyright|redistribut|permission|warrant|mozilla|public[^a-z0-9]+domain|no[^a-z0-9]+event|cc[^a-z0-9]*by|cc0|under[^a-z0-9]+(mit|apache|bsd|l?a?gpl|mpl|epl|bsl|zlib|isc)|creative"

WHITE = r"[\x20\x09-\x0D]"
BREAK = "\u0001"


def known_sentences() -> dict[str, str]:
    """Normal form to identifier; a statement that names a licence has the identifier named.<licence>."""
    out = {text: key for key, text in SENTENCES.items()}
    for licence, names in NAMES.items():
        for name in names:
            for form in STATEMENTS:
                out[form.format(name)] = f"named.{licence}"
    return out


def rules() -> list[tuple[str, tuple[str, ...]]]:
    return [*RULES, *((licence, (f"named.{licence}",)) for licence in NAMES)]


def marked(text: Column) -> Column:
    """The text with a mark put after each sentence and before each blank line; a mark already in it becomes a space."""
    text = F.translate(text, BREAK, " ")
    text = F.regexp_replace(text, f"([.!?])({WHITE})", f"$1{BREAK}$2")
    return F.regexp_replace(text, r"(\n[\x20\x09\x0B-\x0D]*\n)", f"{BREAK}$1")


def normal(sentence: Column) -> Column:
    """Lower-case words, with the holder's name in sentences that hold one replaced."""
    plain = F.trim(F.regexp_replace(F.translate(sentence, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[^a-z0-9]+", " "))
    for named, put in HOLDERS:
        plain = F.regexp_replace(plain, named, put)
    return plain


def _pieces(text: Column, by: str, width: int, offset: Column) -> Column:
    """Parts of a text between separators of `width` code points, with their start, where a known sentence can be in the part."""

    def placed(parts: Column) -> Column:
        starts = sums_before(F.transform(parts, lambda part: (F.length(part) + width).cast("bigint")), offset)
        return F.filter(F.zip_with(starts, parts, lambda start, part: F.struct(start.alias("start"), part.alias("part"))), lambda p: p["part"].rlike(HINT))

    return let(F.split(text, by, -1), placed)


def _applied(ids: Column) -> Column:
    """Names of the rules that hold in a text of identifiers (<id><id>...), each taking what it matches."""
    all_rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in seq)).alias("seq")) for name, seq in rules()])
    start = F.struct(ids.alias("ids"), F.array().cast("array<string>").alias("names"))

    def apply(acc: Column, rule: Column) -> Column:
        names = F.when(F.contains(acc["ids"], rule["seq"]), F.array_append(acc["names"], rule["name"])).otherwise(acc["names"])
        return F.struct(F.replace(acc["ids"], rule["seq"], F.lit("|")).alias("ids"), names.alias("names"))

    return F.aggregate(all_rules, start, apply, lambda acc: F.array_sort(F.array_distinct(acc["names"])))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, licenses (sorted array), sentences: array of known sentences in order (id, start, end).

    Offsets are code points, the end exclusive, with the white space around the sentence. One row per input row; null and
    empty texts have none; rows that repeat are scanned alike; an empty table gives no rows. The work is linear in a text's length.
    """
    table = F.create_map(*[F.lit(x) for pair in known_sentences().items() for x in pair])
    text = F.coalesce(F.col(text_col), F.lit(""))
    found_type = "array<struct<id:string,start:bigint,end:bigint>>"
    zero = F.lit(0).cast("bigint")

    def looked_up(p: Column) -> Column:
        return F.struct(F.element_at(table, normal(p["part"])).alias("id"), p["start"].alias("start"), (p["start"] + F.length(p["part"])).alias("end"))

    def of_sentence(p: Column) -> Column:
        lines = F.filter(F.transform(_pieces(p["part"], "\n", 1, p["start"]), looked_up), lambda f: f["id"].isNotNull())
        return let(looked_up(p), lambda whole: F.when(whole["id"].isNotNull(), F.array(whole)).otherwise(lines))

    sentences = F.flatten(F.transform(_pieces(marked(text), BREAK, 0, zero), of_sentence))
    found = F.when(text.rlike(HINT), sentences).otherwise(F.array().cast(found_type))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), found.alias("sentences"))
    ids = F.array_join(F.transform("sentences", lambda s: F.concat(F.lit("<"), s["id"], F.lit(">"))), "")
    licenses = F.when(F.size("sentences") > 0, _applied(ids))
    return rows.select("doc_id", F.coalesce(licenses, F.array().cast("array<string>")).alias("licenses"), "sentences")


def scan_sql() -> str:
    """The scan in SQL: columns doc_id, licenses, n_known, sentence_ids."""
    known = ", ".join(f"('{k}', '{v}')" for k, v in known_sentences().items())
    white = r"[\x20\x09-\x0D]"
    steps, last = [], "joined"
    for i, (name, seq) in enumerate(rules()):
        ids = "".join(f"<{s}>" for s in seq)
        steps.append(f"step{i} AS (SELECT doc_id, n_known, sentence_ids, CASE WHEN contains(ids, '{ids}') THEN list_append(names, '{name}') ELSE names END AS names, replace(ids, '{ids}', '|') AS ids FROM {last})")
        last = f"step{i}"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


    def norm(x: str) -> str:
        plain = f"trim(regexp_replace({lower.format(x)}, '[^a-z0-9]+', ' ', 'g'))"
        for named, put in HOLDERS:
            plain = f"regexp_replace({plain}, '{named}', '{put}')"
        return plain

    return rf"""
WITH known(form, id) AS (VALUES {known}),
marked AS (
  SELECT doc_id, regexp_replace(regexp_replace(translate(coalesce(text, ''), chr(1), ' '), '([.!?])({white})', '\1' || chr(1) || '\2', 'g'),
                                '(\n[\x20\x09\x0B-\x0D]*\n)', chr(1) || '\1', 'g') AS t FROM documents
), sentences AS (
  SELECT doc_id, unnest(string_split(t, chr(1))) AS s, generate_subscripts(string_split(t, chr(1)), 1) AS i FROM marked
), whole AS (
  SELECT x.doc_id, x.i, x.s, k.id FROM sentences x LEFT JOIN known k ON {norm("x.s")} = k.form
), lines AS (
  SELECT doc_id, i, unnest(string_split(s, chr(10))) AS l, generate_subscripts(string_split(s, chr(10)), 1) AS j FROM whole WHERE id IS NULL
), found AS (
  SELECT doc_id, i, 0 AS j, id FROM whole WHERE id IS NOT NULL
  UNION ALL SELECT y.doc_id, y.i, y.j, k.id FROM lines y JOIN known k ON {norm("y.l")} = k.form
), joined AS (
  SELECT d.doc_id, CAST(count(f.id) AS BIGINT) AS n_known, coalesce(string_agg(f.id, ',' ORDER BY f.i, f.j), '') AS sentence_ids,
         CAST([] AS VARCHAR[]) AS names, coalesce(string_agg('<' || f.id || '>', '' ORDER BY f.i, f.j), '') AS ids
  FROM documents d LEFT JOIN found f ON d.doc_id = f.doc_id GROUP BY d.doc_id
), {", ".join(steps)}
SELECT doc_id, array_to_string(list_sort(list_distinct(names)), ',') AS licenses, n_known, sentence_ids FROM {last}
"""
