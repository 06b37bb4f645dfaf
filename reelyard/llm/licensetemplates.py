"""Licence templates in a small markup, for the licence scan.

Markup: plain words are mandatory; ``<<beginOptional>>`` ... ``<<endOptional>>`` may be left out as a whole (optional
regions nest); ``<<var;0-8>>`` stands for any words, here none to eight of them.  Case and punctuation never count.

Fixed values: the wording of public licences and of their usual notices.  ``labels`` are lower-case SPDX identifiers.
"""

PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_NOTICE = "<<beginOptional>>This <<var;1-3>> is<<endOptional>> <<beginOptional>>Licensed<<endOptional>> <<beginOptional>>Released<<endOptional>> under <<beginOptional>>the terms of<<endOptional>> <<beginOptional>>the<<endOptional>> "

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
    "<<beginOptional>>THE<<endOptional>> <<var;1-8>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)

_BSD_HEAD = (
    "Redistribution and use <<beginOptional>>of this software<<endOptional>> in source and binary forms, with or without "
    "modification, are permitted provided that the following conditions are met: <<var;0-1>> Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following disclaimer. <<var;0-1>> "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)

_BSD_THIRD = (
    "<<var;0-1>> Neither the name of <<beginOptional>>the<<endOptional>> <<var;1-10>> nor the names of its contributors may "
    "be used to endorse or promote products derived from this software without specific prior written permission. "
)

_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY <<var;1-12>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
    "<<var;1-12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, "
    "BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE."
)

TEMPLATES: list[tuple[str, str]] = [
    # Notices.
    ("apache-2.0", _NOTICE + "Apache License, <<beginOptional>>Version<<endOptional>> 2.0"),
    ("gpl-2.0", _NOTICE + "GNU General Public License, <<beginOptional>>version<<endOptional>> <<beginOptional>>v<<endOptional>> 2"),
    ("gpl-3.0", _NOTICE + "GNU General Public License, <<beginOptional>>version<<endOptional>> <<beginOptional>>v<<endOptional>> 3"),
    ("lgpl-3.0", _NOTICE + "GNU Lesser General Public License, <<beginOptional>>version<<endOptional>> 3"),
    ("agpl-3.0", _NOTICE + "GNU Affero General Public License, <<beginOptional>>version<<endOptional>> 3"),
    ("mpl-2.0", _NOTICE + "Mozilla Public License, <<beginOptional>>version<<endOptional>> 2.0"),
    ("mit", _NOTICE + "MIT License"),
    ("cc-by-4.0", _NOTICE + "CC BY 4.0"),
    ("cc-by-sa-4.0", _NOTICE + "CC BY-SA 4.0"),
    ("cc-by-nc-4.0", _NOTICE + "CC BY-NC 4.0"),
    ("cc-by-nd-4.0", _NOTICE + "CC BY-ND 4.0"),
    ("cc-by-nc-sa-4.0", _NOTICE + "CC BY-NC-SA 4.0"),
    ("cc-by-4.0", _NOTICE + "Creative Commons Attribution 4.0 <<beginOptional>>International<<endOptional>> License"),
    ("cc-by-sa-4.0", _NOTICE + "Creative Commons Attribution-ShareAlike 4.0 <<beginOptional>>International<<endOptional>> License"),
    # Whole texts.
    (
        "mit",
        "<<beginOptional>>The MIT License (MIT)<<endOptional>> <<beginOptional>>Copyright <<var;0-12>><<endOptional>> "
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included "
        "in all copies or substantial portions of the Software. " + _AS_IS,
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND <<var;1-8>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE',
    ),
    ("bsd-2-clause", _BSD_HEAD + _BSD_TAIL),
    ("bsd-3-clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:",
    ),
    (
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at <<beginOptional>>http<<endOptional>> "
        "<<beginOptional>>https<<endOptional>> www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        'to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
    ),
    (
        "gpl-3.0-or-later",
        "<<var;1-3>> is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
    ),
    (
        "gpl-2.0-or-later",
        "<<var;1-3>> is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
]
