"""Public licence wordings as templates. Fixed values.

Only words count; case and all that stands between words don't. Markup:

    <<beginOptional>> ... <<endOptional>>   may be left out; may be nested
    <<var;words=M-N>>                       M to N words of any kind
    <<var;match=one phrase|another>>        one of these phrases
"""

_AS_IS = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
<<var;match=NONINFRINGEMENT|NON-INFRINGEMENT>>. IN NO EVENT SHALL <<var;words=1-12>> BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""

_BSD_CLAUSES = """
Redistribution and use <<beginOptional>>of this software<<endOptional>> in source and binary forms, with or
without modification, are permitted provided that the following conditions are met:
<<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.
<<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution.
"""

_BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY <<var;words=1-12>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL <<var;words=1-12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

_WORK = "<<var;match=work|program|software|library|project|file|document|text|page|code>>"
_GIVEN = "<<var;match=licensed|released|distributed|available|published>>"

#: (label, template). A label may have several.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("mit", f"""
<<beginOptional>>The MIT License (MIT) Copyright (c) <<var;words=0-12>><<endOptional>>
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>>
shall be included in all copies or substantial portions of the Software.
{_AS_IS}"""),
    ("mit", f"{_GIVEN} under the <<beginOptional>>terms of the<<endOptional>> MIT license"),
    ("isc", """
Permission to use, copy, modify, <<var;match=and/or|and>> distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND <<var;words=1-12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;words=1-12>> BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA
OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd-2-clause", _BSD_CLAUSES + _BSD_DISCLAIMER),
    ("bsd-3-clause", f"""{_BSD_CLAUSES}
<<beginOptional>>3.<<endOptional>> Neither the name of <<var;words=1-12>> nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written permission.
{_BSD_DISCLAIMER}"""),
    ("apache-2.0", """
Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License"); you may not use this
<<var;match=file|work|software>> except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied.<<endOptional>>"""),
    ("gpl-3.0", f"""{_WORK} is {_GIVEN} under the <<beginOptional>>terms of the<<endOptional>> GNU General Public
License<<beginOptional>> as published by the Free Software Foundation; either<<endOptional>>, version 3"""),
    ("gpl-3.0", """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, <<var;match=either version 3|version 3>>
<<beginOptional>>of the License<<endOptional>>"""),
    ("gpl-2.0", """
This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation; <<var;match=either version 2|version 2>>
<<beginOptional>>of the License<<endOptional>>"""),
    ("cc-by-4.0", f"{_GIVEN} under <<beginOptional>>the<<endOptional>> <<beginOptional>>a<<endOptional>> "
     "<<var;match=CC BY|Creative Commons Attribution>> 4.0"),
    ("cc-by-sa-4.0", f"{_GIVEN} under <<beginOptional>>the<<endOptional>> <<beginOptional>>a<<endOptional>> "
     "<<var;match=CC BY-SA|Creative Commons Attribution-ShareAlike>> 4.0"),
    ("cc-by-nc-4.0", f"{_GIVEN} under <<beginOptional>>the<<endOptional>> <<beginOptional>>a<<endOptional>> "
     "<<var;match=CC BY-NC|Creative Commons Attribution-NonCommercial>> 4.0"),
    ("zlib", """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the
following restrictions: <<beginOptional>>1.<<endOptional>> The origin of this software must not be misrepresented;
you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment
in the product documentation would be appreciated but is not required. <<beginOptional>>2.<<endOptional>> Altered
source versions must be plainly marked as such, and must not be misrepresented as being the original software.
<<beginOptional>>3.<<endOptional>> This notice may not be removed or altered from any source distribution."""),
    ("unlicense", """
This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means."""),
)

#: Phrases that count wherever their words stand in a row, and their labels. Fixed values.
PHRASES: tuple[tuple[str, str], ...] = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)
