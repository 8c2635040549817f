"""What the licence scan looks for by default: ``ROWS`` of a licence and one wording of it.

Short notices in their usual variants, the notices that licences ask to be put into files, and
passages of the licences' own texts, which a copy of the whole text holds too. Where two licences
share a text but for a name or a version, a row is cut so that the difference takes over a fifth
of its shingles.
"""

from __future__ import annotations

#: Names that follow "licensed under the" and its like.
_NAMES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": ("GNU Affero General Public License {3}", "GNU AGPL {3}", "Affero General Public License {3}"),
    "Apache-2.0": ("Apache License {2.0}", "Apache 2.0 License", "Apache Software License {2.0}", "Apache-2.0 license"),
    "Artistic-2.0": ("Artistic License {2.0}",),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "BSL-1.0": ("Boost Software License {1.0}",),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0", "CC BY 4.0 license"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0", "CC BY-NC 4.0 license"),
    "CC-BY-NC-ND-4.0": ("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0", "CC BY-NC-ND 4.0 license"),
    "CC-BY-NC-SA-4.0": ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "CC BY-NC-SA 4.0 license"),
    "CC-BY-ND-4.0": ("Creative Commons Attribution-NoDerivatives 4.0", "CC BY-ND 4.0 license"),
    "CC-BY-SA-3.0": ("Creative Commons Attribution-ShareAlike 3.0", "CC BY-SA 3.0 license"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0", "CC BY-SA 4.0 license"),
    "CC0-1.0": ("Creative Commons Zero", "CC0 1.0 Universal", "CC0 license"),
    "EPL-2.0": ("Eclipse Public License {2.0}",),
    "GPL-2.0": ("GNU General Public License {2}", "GNU GPL {2}"),
    "GPL-3.0": ("GNU General Public License {3}", "GNU GPL {3}"),
    "ISC": ("ISC License",),
    "LGPL-2.1": ("GNU Lesser General Public License {2.1}", "GNU LGPL {2.1}"),
    "LGPL-3.0": ("GNU Lesser General Public License {3}", "GNU LGPL {3}"),
    "MIT": ("MIT License", "MIT/X11 License", "Expat License"),
    "MPL-2.0": ("Mozilla Public License {2.0}",),
    "Unlicense": ("The Unlicense license", "Unlicense license"),
    "Zlib": ("zlib License", "zlib/libpng License"),
}
_LEADS = ("licensed under the", "licensed under", "released under the", "distributed under the", "under the terms of the")
_VERSIONS = ("v{}", "version {}", "{}", "v. {}")

_GNU = "terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at"
_TEXTS: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", _GNU.format("Affero ", "3")),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("AGPL-3.0", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSD-3-Clause", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("CC0-1.0", "has waived all copyright and related or neighboring rights to this work"),
    ("CC0-1.0", "has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("GPL-2.0", _GNU.format("", "2")),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software"),
    ("GPL-3.0", _GNU.format("", "3")),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June"),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most software and other practical works"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice"),
    ("LGPL-2.1", _GNU.format("Lesser ", "2.1")),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", _GNU.format("Lesser ", "3")),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-3.0", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
)


def _named() -> list[tuple[str, str]]:
    out = []
    for licence, names in _NAMES.items():
        for name in names:
            if "{" in name:
                start, number = name[:-1].split("{")
                own = [start + v.format(number + more) for v in _VERSIONS for more in ("", ".0")[: 2 - ("." in number)]]
            else:
                own = [name]
            # Of eight words another last one leaves three of four shingles: under four fifths.
            out += [(licence, " ".join(f"{lead} {n}".replace("-", " ").split()[-8:])) for n in own for lead in _LEADS]
    return out


ROWS: tuple[tuple[str, str], ...] = (*_named(), *_TEXTS)
