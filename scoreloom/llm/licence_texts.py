"""Fixed values of the license scan: notices, headers and the texts or openings of licence files.

``TELLING`` names terms that tell licences of much the same wording apart: those that must stand in a window (``a|b``:
one of them), those that must not, how many terms after the window are read with it, and terms that must not stand among
the forty before it (the Mozilla licence lists others as secondary ones).
"""

from __future__ import annotations

_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
    " the following conditions are met"
)
_BSD_LISTED = (
    _BSD + ": 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the"
    " following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
    " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to"
    " permit persons to whom the Software is furnished to do so"
)
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_VERBATIM = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."


def _gnu(kind: str, version: str, opening: list[str], thing: str = "program") -> list[str]:
    """The notice lines and headers of a GNU licence, and the opening of its file."""
    name = f"GNU {kind}General Public License"
    start = f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the {name}"
    return [
        f"This work is licensed under the {name}, version {version}",
        f"{name} version {version}",
        f"{start} as published by the Free Software Foundation, either version {version} of the License, or (at your option)"
        " any later version",
        f"{start} as published by the Free Software Foundation, version {version} of the License",
        f"{start} version {version} as published by the Free Software Foundation",
        *opening,
    ]


def _creative(kind: str, short: str, version: str) -> list[str]:
    scope = {"4.0": "International", "3.0": "Unported"}[version]
    name = f"Creative Commons {kind} {version} {scope}"
    body = {
        "4.0": f"{name} Public License By exercising the Licensed Rights (defined below), You accept and agree to be bound by"
        f" the terms and conditions of this {name} Public License",
        "3.0": f"Creative Commons Legal Code {kind} {version} {scope} CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES"
        " NOT PROVIDE LEGAL SERVICES. DISTRIBUTION OF THIS LICENSE DOES NOT CREATE AN ATTORNEY-CLIENT RELATIONSHIP.",
    }[version]
    return [
        f"Licensed under CC {short} {version}",
        f"licensed under a {name} License",
        f"This work is licensed under the {name} License. To view a copy of this license, visit"
        f" http://creativecommons.org/licenses/{short.lower()}/{version}/",
        body,
    ]


_KINDS = {
    "BY": ("Attribution", "", "nc|noncommercial sa|sharealike nd|noderivatives|noderivs"),
    "BY-NC": ("Attribution-NonCommercial", "nc|noncommercial", "sa|sharealike nd|noderivatives|noderivs"),
    "BY-SA": ("Attribution-ShareAlike", "sa|sharealike", "nc|noncommercial nd|noderivatives|noderivs"),
    "BY-ND": ("Attribution-NoDerivatives", "nd|noderivatives|noderivs", "nc|noncommercial sa|sharealike"),
    "BY-NC-SA": ("Attribution-NonCommercial-ShareAlike", "nc|noncommercial sa|sharealike", "nd|noderivatives|noderivs"),
    "BY-NC-ND": ("Attribution-NonCommercial-NoDerivatives", "nc|noncommercial nd|noderivatives|noderivs", "sa|sharealike"),
}

TEMPLATES: dict[str, list[str]] = {
    "0BSD": [_ISC + ". THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"],
    "AGPL-3.0": _gnu("Affero ", "3", [
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _VERBATIM,
    ]),
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with"
        " the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by"
        " applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION,"
        " AND DISTRIBUTION 1. Definitions. \"License\" shall mean the terms and conditions for use, reproduction, and"
        " distribution as defined by Sections 1 through 9 of this document.",
    ],
    "BSD-2-Clause": [_BSD, _BSD_LISTED],
    "BSD-3-Clause": [_BSD, _BSD_LISTED],
    "BSD-4-Clause": [_BSD, _BSD_LISTED],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0",
        "Boost Software License Version 1.0 August 17th, 2003 Permission is hereby granted, free of charge, to any person or"
        " organization obtaining a copy of the software and accompanying documentation covered by this license (the"
        " \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software",
    ],
    "CC0-1.0": [
        "Licensed under CC0 1.0 Universal",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL"
        " SERVICES. DISTRIBUTION OF THIS DOCUMENT DOES NOT CREATE AN ATTORNEY-CLIENT RELATIONSHIP.",
    ],
    **{f"CC-{s}-{v}": _creative(k, s, v) for s, (k, _, _) in _KINDS.items() for v in ("4.0", "3.0")},
    "EPL-1.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which"
        " accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
        "Eclipse Public License - v 1.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE"
        " (\"AGREEMENT\"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is"
        " available at https://www.eclipse.org/legal/epl-2.0/",
        "Eclipse Public License - v 2.0 THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE"
        " (\"AGREEMENT\"). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.",
    ],
    "GFDL-1.3": [
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation"
        " License, Version 1.3 or any later version published by the Free Software Foundation",
        "GNU Free Documentation License Version 1.3, 3 November 2008 Copyright (C) 2000, 2001, 2002, 2007, 2008 Free Software"
        " Foundation, Inc. " + _VERBATIM,
    ],
    "GPL-2.0": _gnu("", "2", [
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc., 51 Franklin"
        " Street, Fifth Floor, Boston, MA 02110-1301 USA " + _VERBATIM + " Preamble The licenses for most software are designed"
        " to take away your freedom to share and change it.",
    ]),
    "GPL-3.0": _gnu("", "3", [
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _VERBATIM
        + " Preamble The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    ]),
    "ISC": [_ISC, _ISC + ", provided that the above copyright notice and this permission notice appear in all copies."],
    "LGPL-2.0": _gnu("Library ", "2", [
        "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1991 Free Software Foundation, Inc. 51 Franklin"
        " Street, Fifth Floor, Boston, MA 02110-1301 USA " + _VERBATIM,
    ], "library"),
    "LGPL-2.1": _gnu("Lesser ", "2.1", [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc. 51"
        " Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA " + _VERBATIM,
    ], "library"),
    "LGPL-3.0": _gnu("Lesser ", "3", [
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. " + _VERBATIM,
    ], "library"),
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction",
        _MIT + ", subject to the following conditions: The above copyright notice and this permission notice shall be included in"
        " all copies or substantial portions of the Software.",
    ],
    "MIT-0": [_MIT + ". THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"],
    "MPL-1.1": [
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this"
        " file except in compliance with the License.",
        "MOZILLA PUBLIC LICENSE Version 1.1 1. Definitions. 1.0.1. \"Commercial Use\" means distribution or otherwise making the"
        " Covered Code available to a third party.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that"
        " creates, contributes to the creation of, or owns Covered Software.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable"
        " for any damages arising from the use of this software. Permission is granted to anyone to use this software for any"
        " purpose, including commercial applications, and to alter it and redistribute it freely",
    ],
}

TELLING: dict[str, tuple] = {
    "0BSD": ("disclaims", "appear", 0),
    "AGPL-3.0": ("affero 3|v3", "", 0, "secondary"),
    "Apache-2.0": ("apache 2", "", 0),
    "BSD-2-Clause": ("", "endorse advertising", 200),
    "BSD-3-Clause": ("endorse", "advertising", 200),
    "BSD-4-Clause": ("endorse advertising", "", 200),
    "BSL-1.0": ("boost", "", 0),
    "CC0-1.0": ("cc0|waived", "", 0),
    **{f"CC-{s}-{v}.0": (f"{v} {must}", barred, 0) for s, (_, must, barred) in _KINDS.items() for v in "43"},
    "EPL-1.0": ("eclipse 1|v1", "", 0),
    "EPL-2.0": ("eclipse 2|v2", "", 0),
    "GFDL-1.3": ("documentation 1 3", "", 0),
    "GPL-2.0": ("2|v2", "lesser affero", 0, "secondary"),
    "GPL-3.0": ("3|v3", "lesser affero", 0, "secondary"),
    "LGPL-2.0": ("library 2|v2", "lesser affero", 0, "secondary"),
    "LGPL-2.1": ("lesser 2 1", "affero", 0, "secondary"),
    "LGPL-3.0": ("lesser 3|v3", "affero", 0, "secondary"),
    "MIT-0": ("warranty", "notice", 0),
    "MPL-1.1": ("mozilla 1", "", 0),
    "MPL-2.0": ("2", "", 0),
}
