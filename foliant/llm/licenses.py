"""Licence recognition from sentences, in DataFrame functions only.

A text is normalised (A-Z lower-cased, comment leaders and runs of other than a-z and 0-9 to one
space) and cut at ends of clauses and lines. A known licence sentence is found where it is a
run of whole pieces inside one paragraph: on one line or wrapped, and with marks as in 'v. 2.0'
or 'free software: you can' inside it; of runs that overlap, the first counts, and the longest
that begins there. Besides whole sentences these are known: sentences with a gap for a holder's name, references such as "this file is distributed under the
terms of the" and a licence's name, and SPDX tags. A document's identifiers, in order, are held against ordered rules: a rule matches if its identifiers occur in its order,
others between them or not. A rule that is a part of another matched rule is left out.

Defined cases: a null or empty text has no sentences and no licence; a very long text is whole, one row of one task; repeated sentences repeat
their identifier; rows with equal ids are rows of their own; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import UPPER, lower_ascii

# Sentences of public licence texts and notices, normalised, with our identifiers.
SENTENCES = {
    "released under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "this project is licensed under the mit license": "mit-ref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-asis",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit-liability",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-asis",
    "licensed under the apache license version 2 0": "apache2-ref",
    "licensed under the apache license version 2 0 the license": "apache2-ref",
    "you may not use this file except in compliance with the license": "apache2-comply",
    "you may obtain a copy of the license at": "apache2-obtain",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache2-asis",
    "see the license for the specific language governing permissions and limitations under the license": "apache2-see",
    "this work is licensed under the gnu general public license version 3": "gpl3-ref",
    "licensed under the gnu general public license version 3": "gpl3-ref",
    "this work is licensed under the gnu general public license version 2": "gpl2-ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-grant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "see the gnu general public license for more details": "gpl-details",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2-ref",
    "licensed under cc by nc 4 0": "ccbync4-ref",
    "licensed under cc by 4 0": "ccby4-ref",
    "licensed under cc by sa 4 0": "ccbysa4-ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby4-ref",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lgpl21-grant",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "lgpl-warranty",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3-grant",
    "licensed under the gnu affero general public license version 3": "agpl3-ref",
    "licensed under the gnu lesser general public license version 3": "lgpl3-ref",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "this software is provided as is without any express or implied warranty": "zlib-asis",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "bsl1-grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl2-ref",
    "licensed under cc0 1 0": "cc0-ref",
}
# Grants, titles and conditions, with * for one to twelve words of a name.
GAPS = {
    "neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "neither the names of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "neither the name of * nor the names of their contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "the name of * may not be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "the names of * may not be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "this software is provided by * and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-asis",
    "this software is provided by * as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-asis",
    "all advertising materials mentioning features or use of this software must display the following acknowledgement": "bsd-advert",
    "apache license version 2 0 january 2004": "apache2-title",
    "terms and conditions for use reproduction and distribution": "apache2-terms",
    "mozilla public license version 2 0": "mpl2-title",
    "gnu general public license version 3 29 june 2007": "gpl3-title",
    "gnu general public license version 2 june 1991": "gpl2-title",
    "gnu lesser general public license version 3 29 june 2007": "lgpl3-title",
    "gnu lesser general public license version 2 1 february 1999": "lgpl21-title",
    "gnu affero general public license version 3 19 november 2007": "agpl3-title",
    "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed": "fsf-copy",
}
FAMILIES = {"gpl": "gnu general public license", "lgpl": "gnu lesser general public license", "agpl": "gnu affero general public license"}
VERSIONS = {"gpl": {"2": "2", "3": "3"}, "lgpl": {"21": "2 1", "3": "3"}, "agpl": {"3": "3"}}
GRANT = "this {} is free software you can redistribute it and or modify it under the terms of the {} as published by the free software foundation {}"
for _family, _named in FAMILIES.items():
    for _short, _version in VERSIONS[_family].items():
        for _what in ("program", "library", "file", "software"):
            GAPS[GRANT.format(_what, _named, f"either version {_version} of the license or at your option any later version")] = f"{_family}{_short}-grant"
            GAPS[GRANT.format(_what, _named, f"version {_version} of the license")] = f"{_family}{_short}-only"
            GAPS[GRANT.format(_what, _named, f"version {_version}")] = f"{_family}{_short}-only"
            GAPS[GRANT.format(_what, _named, f"version {_version} only")] = f"{_family}{_short}-only"
# Licence, identifier, and names by which texts refer to it.
NAMES = [
    ("MIT", "mit-ref", ["mit license", "mit licence"]),
    ("Apache-2.0", "apache2-ref", ["apache license version 2 0", "apache license version 2 0 the license", "apache license v2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0"]),
    ("BSD-3-Clause", "bsd3-ref", ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "bsd 3 clause"]),
    ("BSD-2-Clause", "bsd2-ref", ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "bsd 2 clause"]),
    ("ISC", "isc-ref", ["isc license", "isc licence"]),
    ("GPL-3.0-only", "gpl3-ref", ["gnu general public license version 3", "gnu general public license v3", "gnu general public license v3 0", "gnu gpl version 3", "gnu gpl v3", "gnu gplv3", "gpl v3", "gplv3", "gpl version 3"]),
    ("GPL-3.0-or-later", "gpl3plus-ref", ["gnu general public license version 3 or later", "gnu general public license version 3 or any later version", "gnu general public license v3 or later", "gnu gpl v3 or later", "gplv3 or later", "gpl v3 or later"]),
    ("GPL-2.0-only", "gpl2-ref", ["gnu general public license version 2", "gnu general public license v2", "gnu general public license v2 0", "gnu gpl version 2", "gnu gpl v2", "gnu gplv2", "gpl v2", "gplv2", "gpl version 2"]),
    ("GPL-2.0-or-later", "gpl2plus-ref", ["gnu general public license version 2 or later", "gnu general public license version 2 or any later version", "gnu general public license v2 or later", "gnu gpl v2 or later", "gplv2 or later", "gpl v2 or later"]),
    ("LGPL-2.1-only", "lgpl21-ref", ["gnu lesser general public license version 2 1", "gnu lgpl version 2 1", "lgpl v2 1", "lgplv2 1"]),
    ("LGPL-2.1-or-later", "lgpl21plus-ref", ["gnu lesser general public license version 2 1 or later", "lgpl v2 1 or later", "lgplv2 1 or later"]),
    ("LGPL-3.0-only", "lgpl3-ref", ["gnu lesser general public license version 3", "gnu lgpl version 3", "lgpl v3", "lgplv3"]),
    ("LGPL-3.0-or-later", "lgpl3plus-ref", ["gnu lesser general public license version 3 or later", "lgpl v3 or later", "lgplv3 or later"]),
    ("AGPL-3.0-only", "agpl3-ref", ["gnu affero general public license version 3", "gnu agpl version 3", "gnu agplv3", "agpl v3", "agplv3"]),
    ("AGPL-3.0-or-later", "agpl3plus-ref", ["gnu affero general public license version 3 or later", "agpl v3 or later", "agplv3 or later"]),
    ("MPL-2.0", "mpl2-ref", ["mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0", "mpl 2 0"]),
    ("EPL-1.0", "epl1-ref", ["eclipse public license v1 0", "eclipse public license 1 0", "eclipse public license version 1 0"]),
    ("EPL-2.0", "epl2-ref", ["eclipse public license v2 0", "eclipse public license 2 0", "eclipse public license version 2 0", "eclipse public license v 2 0"]),
    ("BSL-1.0", "bsl1-ref", ["boost software license version 1 0", "boost software license 1 0", "boost software license"]),
    ("Zlib", "zlib-ref", ["zlib license"]),
    ("Unlicense", "unlicense-ref", ["unlicense"]),
    ("CC0-1.0", "cc0-ref", ["cc0 1 0", "cc0 1 0 universal", "creative commons zero v1 0 universal license", "creative commons cc0 1 0 universal license"]),
    ("CC-BY-3.0", "ccby3-ref", ["cc by 3 0", "creative commons attribution 3 0 unported license"]),
    ("CC-BY-SA-3.0", "ccbysa3-ref", ["cc by sa 3 0", "creative commons attribution sharealike 3 0 unported license"]),
    ("CC-BY-4.0", "ccby4-ref", ["cc by 4 0", "creative commons attribution 4 0 international license"]),
    ("CC-BY-SA-4.0", "ccbysa4-ref", ["cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"]),
    ("CC-BY-NC-4.0", "ccbync4-ref", ["cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"]),
    ("CC-BY-ND-4.0", "ccbynd4-ref", ["cc by nd 4 0", "creative commons attribution noderivatives 4 0 international license"]),
    ("CC-BY-NC-SA-4.0", "ccbyncsa4-ref", ["cc by nc sa 4 0", "creative commons attribution noncommercial sharealike 4 0 international license"]),
    ("CC-BY-NC-ND-4.0", "ccbyncnd4-ref", ["cc by nc nd 4 0", "creative commons attribution noncommercial noderivatives 4 0 international license"]),
    ("Artistic-2.0", "artistic2-ref", ["artistic license 2 0", "artistic license version 2 0"]),
    ("EUPL-1.2", "eupl12-ref", ["european union public licence version 1 2", "european union public licence v 1 2", "eupl 1 2"]),
    ("OFL-1.1", "ofl11-ref", ["sil open font license version 1 1", "sil open font license 1 1"]),
    ("MS-PL", "mspl-ref", ["microsoft public license"]),
    ("CDDL-1.0", "cddl1-ref", ["common development and distribution license", "common development and distribution license version 1 0"]),
    ("WTFPL", "wtfpl-ref", ["wtfpl", "do what the fuck you want to public license"]),
    ("PSF-2.0", "psf2-ref", ["python software foundation license", "psf license"]),
    ("Vim", "vim-ref", ["vim license"]),
    ("PostgreSQL", "postgresql-ref", ["postgresql license"]),
    ("NCSA", "ncsa-ref", ["university of illinois ncsa open source license"]),
]
LEAD = "(?:this (?:work|project|software|file|program|library|code|package|module) is )?(?:licensed|released|distributed|published|available) under (?:the |an? )?(?:terms of (?:the )?)?"
# Identifiers of SPDX tags beside those of NAMES.
TAGS = ["0BSD", "AFL-3.0", "Apache-1.1", "BSD-4-Clause", "BlueOak-1.0.0", "BUSL-1.1", "CC-BY-ND-3.0", "CC-BY-NC-3.0", "CPL-1.0", "ECL-2.0", "GPL-1.0-or-later", "HPND", "LGPL-2.0-only", "LGPL-2.0-or-later", "MIT-0", "MPL-1.1", "MS-RL", "ODbL-1.0", "OpenSSL", "OSL-3.0", "PHP-3.01", "Python-2.0", "QPL-1.0", "Ruby", "SSPL-1.0", "UPL-1.0", "W3C", "X11", "ZPL-2.1"]
# Tags of older lists, by the licence that they mean.
OLD_TAGS = {"GPL-2.0": "GPL-2.0-only", "GPL-2.0+": "GPL-2.0-or-later", "GPL-3.0": "GPL-3.0-only", "GPL-3.0+": "GPL-3.0-or-later", "LGPL-2.1": "LGPL-2.1-only", "LGPL-2.1+": "LGPL-2.1-or-later", "LGPL-3.0": "LGPL-3.0-only", "LGPL-3.0+": "LGPL-3.0-or-later", "AGPL-3.0": "AGPL-3.0-only", "AGPL-3.0+": "AGPL-3.0-or-later"}
TAG = "spdx license identifier "
# Rule name, licence, identifiers in order, and the rules that it is a part of.
RULES = [
    ("mit-text", "MIT", ["mit-grant", "mit-notice", "mit-asis"], []),
    ("mit-notice", "MIT", ["mit-ref"], []),
    ("isc-text", "ISC", ["isc-grant"], []),
    ("bsd3-text", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-asis"], []),
    ("bsd2-text", "BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-asis"], ["bsd3-text"]),
    ("apache2-header", "Apache-2.0", ["apache2-ref", "apache2-comply", "apache2-obtain", "apache2-asis"], []),
    ("apache2-notice", "Apache-2.0", ["apache2-ref"], ["apache2-header"]),
    ("gpl3-header", "GPL-3.0-or-later", ["gpl3-grant", "gpl-warranty"], []),
    ("gpl3-notice", "GPL-3.0-only", ["gpl3-ref"], []),
    ("gpl2-header", "GPL-2.0-or-later", ["gpl2-grant", "gpl-warranty"], []),
    ("gpl2-notice", "GPL-2.0-only", ["gpl2-ref"], []),
    ("mpl2-notice", "MPL-2.0", ["mpl2-ref"], []),
    ("ccbync4-notice", "CC-BY-NC-4.0", ["ccbync4-ref"], []),
    ("ccby4-notice", "CC-BY-4.0", ["ccby4-ref"], []),
    ("ccbysa4-notice", "CC-BY-SA-4.0", ["ccbysa4-ref"], []),
    ("unlicense-text", "Unlicense", ["unlicense-grant"], []),
    ("lgpl21-header", "LGPL-2.1-or-later", ["lgpl21-grant", "lgpl-warranty"], []),
    ("lgpl3-notice", "LGPL-3.0-only", ["lgpl3-ref"], []),
    ("agpl3-header", "AGPL-3.0-or-later", ["agpl3-grant", "gpl-warranty"], []),
    ("agpl3-notice", "AGPL-3.0-only", ["agpl3-ref"], []),
    ("zlib-text", "Zlib", ["zlib-asis", "zlib-grant"], []),
    ("bsl1-text", "BSL-1.0", ["bsl1-grant"], []),
    ("epl2-notice", "EPL-2.0", ["epl2-ref"], []),
    ("cc0-notice", "CC0-1.0", ["cc0-ref"], []),
    ("bsd4-text", "BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-names", "bsd-asis"], []),
    ("apache2-text", "Apache-2.0", ["apache2-title", "apache2-terms"], []),
    ("mpl2-text", "MPL-2.0", ["mpl2-title"], []),
    ("lgpl3-header", "LGPL-3.0-or-later", ["lgpl3-grant"], []),
]
for _family in FAMILIES:
    for _short, _version in VERSIONS[_family].items():
        _spdx = f"{_family.upper()}-" + (_version.replace(" ", ".") if " " in _version else f"{_version}.0")
        _header = [r[0] for r in RULES if r[0] == f"{_family}{_short}-header"]
        if f"{_family}{_short}" != "lgpl3":
            RULES.append((f"{_family}{_short}-grant", f"{_spdx}-or-later", [f"{_family}{_short}-grant"], _header))
        RULES.append((f"{_family}{_short}-only", f"{_spdx}-only", [f"{_family}{_short}-only"], []))
        RULES.append((f"{_family}{_short}-text", f"{_spdx}-only", [f"{_family}{_short}-title", "fsf-copy"], []))
RULES = [(n, i, ids, inside + ["bsd4-text"] if n in ("bsd3-text", "bsd2-text") else inside) for n, i, ids, inside in RULES]
RULES += [(i.replace("-ref", "-notice"), spdx, [i], []) for spdx, i, _ in NAMES if not any(r[2] == [i] for r in RULES)]


def plain(tag: str) -> str:
    """A tag as it is in normalised text."""
    return "".join(c if c.isalnum() else " " for c in tag.lower().replace("+", " or later"))


TAGGED = {TAG + plain(t): (t, OLD_TAGS.get(t, t)) for t in [*(n for n, _, _ in NAMES), *TAGS, *OLD_TAGS]}
SPDX = {sentence: "spdx-" + plain(t).replace(" ", "-") for sentence, (t, _) in TAGGED.items()}
RULES += [(SPDX[sentence], spdx, [SPDX[sentence]], []) for sentence, (_, spdx) in TAGGED.items()]
LEADER = r"^[ \t]*(?:dnl|rem)(?:[ \t\r]|$)"
PARAGRAPH = r"\n[^a-z0-9\n]*\n"
LATER = r"([0-9])\+"
BREAK = r"[.!?;:]+[ \t\r\n]+|\n"
CUE = "licen|permi|copyright|redistribut|warrant|public domain|under (the )?(terms of (the )?)?(gnu|mit|cc|gpl|lgpl|agpl|mpl|apache|bsd|eupl|wtfpl)"


def pattern(identifiers: list[str]) -> str:
    return "," + ",(.*,)?".join(identifiers) + ","


def spaced(expression: str) -> str:
    """An expression for normalised text in which S may stand between words."""
    return expression.replace(" ", "[ S]+")


# Known sentences, longest first, in text where P stands for the end of a paragraph and S for the end of a clause or line; then references and tags.
GAP = "[a-z0-9]+(?: [a-z0-9]+){0,11}?"
WHOLE = sorted([*SENTENCES, *GAPS, *SPDX], key=len, reverse=True)
CALLED = {name: i for _, i, names in NAMES for name in names}
RUNS = "[SP] ?(" + "|".join(spaced(x.replace("*", GAP)) for x in WHOLE) + "|" + spaced(LEAD) + "(?:" + "|".join(spaced(n) for n in sorted(CALLED, key=len, reverse=True)) + ")) ?"
KNOWN = {**SENTENCES, **GAPS, **SPDX, **{f"under {name}": i for name, i in CALLED.items()}}
NAMED = [(f"^{a}{GAP}{b}$", f"{a}*{b}") for a, b in (x.split("*") for x in GAPS if "*" in x)]


def sentence_ids(text) -> F.Column:
    """Identifiers of the known sentences of a text, in order. Every known sentence holds a cue, so texts without are not normalised."""
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])
    low = lower_ascii(text)

    def called(x):
        """A found sentence by the name it is known by: names of holders left out, and what leads to a licence's name."""
        one = F.regexp_replace(x, "[ S]+", " ")
        for expression, name in NAMED:
            one = F.regexp_replace(one, expression, name)
        return F.coalesce(F.try_element_at(known, one), F.try_element_at(known, F.regexp_replace(one, "^" + LEAD, "under ")))

    bare = F.regexp_replace(F.regexp_replace(F.concat(F.lit("\n"), low, F.lit("\n")), "(?md)" + LEADER, ""), LATER, "$1 or later")
    cut = F.regexp_replace(F.regexp_replace(bare, PARAGRAPH, "P"), BREAK, "S")
    found = F.regexp_extract_all(F.regexp_replace(cut, "[^a-z0-9SP]+", " "), F.lit(RUNS + "(?=[SP])"), F.lit(1))
    named = F.transform(found, called)
    return F.when(low.rlike(CUE), F.filter(named, lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_license_sentences, sentence_ids, rules, licenses (each an array) for each row."""
    out = docs.select(F.col(id_col).alias("doc_id"), sentence_ids(F.col(text_col)).alias("sentence_ids"))
    line = F.concat(F.lit(","), F.array_join("sentence_ids", ","), F.lit(","))
    out = out.withColumn("_line", line)
    hit = {name: F.col("_line").rlike(pattern(ids)) for name, _, ids, _ in RULES}
    rules = []
    for name, spdx, _, inside in RULES:
        met = hit[name]
        for other in inside:
            met = met & ~hit[other]
        rules.append(F.when(met, F.struct(F.lit(name).alias("rule"), F.lit(spdx).alias("spdx"))))
    none = F.array().cast("array<struct<rule:string,spdx:string>>")
    out = out.withColumn("_met", F.when(F.size("sentence_ids") > 0, F.filter(F.array(*rules), lambda x: x.isNotNull())).otherwise(none))
    return out.select(
        "doc_id", F.size("sentence_ids").cast("long").alias("n_license_sentences"), "sentence_ids",
        F.transform("_met", lambda x: x["rule"]).alias("rules"), F.array_sort(F.array_distinct(F.transform("_met", lambda x: x["spdx"]))).alias("licenses"),
    )


def oracle() -> str:
    """The same in DuckDB SQL; arrays as comma-joined strings. Its regular expressions cannot look ahead, so marks are doubled: one ends a sentence, one begins the next."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quote(s)}, {quote(i)})" for s, i in KNOWN.items())
    hits = ", ".join(f"regexp_matches(line, {quote(pattern(ids))}) AS h{k}" for k, (_, _, ids, _) in enumerate(RULES))
    at = {name: k for k, (name, *_) in enumerate(RULES)}
    met = [" AND NOT ".join([f"h{k}", *(f"h{at[o]}" for o in inside)]) for k, (_, _, _, inside) in enumerate(RULES)]
    rules = ", ".join(f"CASE WHEN {m} THEN {quote(name)} END" for m, (name, *_) in zip(met, RULES))
    spdx = ", ".join(f"CASE WHEN {m} THEN {quote(s)} END" for m, (_, s, *_) in zip(met, RULES))
    one = "regexp_replace(s, '[ S]+', ' ', 'g')"
    for expression, name in NAMED:
        one = f"regexp_replace({one}, '{expression}', '{name}')"
    return rf"""
WITH known(sentence, id) AS (VALUES {known}),
low AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t FROM documents),
bare AS (SELECT rid, regexp_replace(regexp_replace(chr(10) || t || chr(10), '(?m){LEADER}', '', 'g'), '{LATER}', '\1 or later', 'g') AS t FROM low WHERE regexp_matches(t, '{CUE}')),
cut AS (SELECT rid, regexp_replace(regexp_replace(regexp_replace(t, '{PARAGRAPH}', 'PP', 'g'), '{BREAK}', 'SS', 'g'), '[^a-z0-9SP]+', ' ', 'g') AS t FROM bare),
found AS (SELECT rid, regexp_extract_all(t, '{RUNS}[SP]', 1) AS f FROM cut),
each AS (SELECT rid, k, {one} AS s FROM (SELECT rid, generate_subscripts(f, 1) AS k, unnest(f) AS s FROM found)),
seq AS (SELECT rid, string_agg(coalesce(a.id, b.id), ',' ORDER BY k) AS ids, count(coalesce(a.id, b.id)) AS n FROM each LEFT JOIN known a ON a.sentence = s LEFT JOIN known b ON b.sentence = regexp_replace(s, '^{LEAD}', 'under ') GROUP BY rid),
lines AS (SELECT doc_id, coalesce(n, 0) AS n, coalesce(ids, '') AS ids, ',' || coalesce(ids, '') || ',' AS line FROM low LEFT JOIN seq USING (rid)),
hit AS (SELECT *, {hits} FROM lines)
SELECT doc_id, CAST(n AS BIGINT) AS n_license_sentences, ids AS sentence_ids,
       array_to_string(list_filter([{rules}], lambda x: x IS NOT NULL), ',') AS rules,
       array_to_string(list_sort(list_distinct(list_filter([{spdx}], lambda x: x IS NOT NULL))), ',') AS licenses
FROM hit"""
