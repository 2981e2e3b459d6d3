"""Licence wordings with template markup.

Fixed values: the mandatory words must equal the published texts. ``[[...]]`` is a region that may be missing,
``{{m-n}}`` one that may be replaced by any ``m`` to ``n`` words, ``{{word|other words}}`` one of several wordings.
Case and marks between words do not count.
"""

#: Label and template; a label may have several.
TEMPLATES = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice [[(including the next paragraph)]] shall be included in all copies or substantial portions
        of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
        {{1-12}} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("bsd-2-clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: [[1.]] Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer. [[2.]] Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
        provided with the distribution. [[{{0-6}}]] THIS SOFTWARE IS PROVIDED BY"""),
    ("bsd-3-clause", """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution. [[3.]] Neither the
        name of {{1-12}} nor the names of its contributors may be used to endorse or promote products derived from this
        software without specific prior written permission."""),
    ("zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the
        {{1-6}} be held liable for any damages arising from the use of this software."""),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at {{0-12}} Unless required by applicable law or
        agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS"""),
    ("gpl-2", """{{is free software|may be redistributed}} you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation; [[either]] version 2 of the License"""),
    ("gpl-3", """{{is free software|may be redistributed}} you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the License"""),
    ("gpl-2", """{{licensed|released|distributed}} under [[the terms of]] the GNU General Public License [[(GPL)]]
        {{version 2|v2}}"""),
    ("gpl-3", """{{licensed|released|distributed}} under [[the terms of]] the GNU General Public License [[(GPL)]]
        {{version 3|v3}}"""),
    ("lgpl", """{{licensed|released|distributed}} under [[the terms of]] the GNU Lesser General Public License"""),
    ("mpl-2", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software"""),
    ("cc-by", """licensed under {{a|the|0-0}} Creative Commons Attribution {{3|4}}.0 [[{{International|Unported}}]] License"""),
    ("cc-by-sa", """licensed under {{a|the|0-0}} Creative Commons Attribution-ShareAlike {{3|4}}.0"""),
    ("cc-by-nc", """licensed under {{a|the|0-0}} Creative Commons Attribution-NonCommercial {{3|4}}.0"""),
    ("cc0", """CC0 1.0 Universal"""),
]
