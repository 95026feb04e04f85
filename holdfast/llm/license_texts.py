"""Whole public license texts and notices in the markup of license_scan, by label."""


def opt(text: str) -> str:
    return f"<<beginOptional>> {text} <<endOptional>>"


def var(words: int, match: str = ".+") -> str:
    return f'<<var;match="{match}";words={words}>>'


VERSION = var(2, "[0-9]+")

MIT = f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice {opt("(including the next paragraph)")} shall be included in all copies or substantial portions
of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
{var(10)} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

BSD_OPENING = f"""Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: {opt("1.")} Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. {opt("2.")} Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution."""

BSD_NAMES = f"""{opt("3.")} Neither the name of {var(10)} nor the names of {opt("its")} {opt(var(6))} contributors may be used
to endorse or promote products derived from this software without specific prior written permission."""

BSD_CLOSING = f"""THIS SOFTWARE IS PROVIDED BY {var(10)} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL {var(10)} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

ISC = f"""Permission to use, copy, modify, {opt("and")} {opt("or")} distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
SOFTWARE IS PROVIDED "AS IS" AND {var(6)} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL {var(6)} BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""

ZLIB = f"""This software is provided 'as-is', without any express or implied warranty. In no event will {var(6)} be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: {opt("1.")} The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required. {opt("2.")} Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. {opt("3.")} This notice may not be removed or altered from any source
distribution."""

UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or
authors of this software dedicate any and all copyright interest in the software to the public domain. We make this
dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under
copyright law."""

APACHE = f"""Licensed under the Apache License, Version 2.0 (the "License"); you may not use {var(3)} except in compliance
with the License. You may obtain a copy of the License at {opt("http://www.apache.org/licenses/LICENSE-2.0")}
{opt("https://www.apache.org/licenses/LICENSE-2.0")} Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the License."""


def gnu_notice(kind: str) -> str:
    """The notice that asks to be put into each source file, for one of the family of public licenses."""
    return f"""This {var(4)} is free software {opt(":")} you can redistribute it and/or modify it under the terms of the GNU
{kind} Public License as published by the Free Software Foundation; {opt("either")} version {VERSION} {opt("of the License")}
{opt("or (at your option) any later version")}. {opt("This")} {var(4)} is distributed in the hope that it will be useful, but
WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
GNU {kind} Public License for more details."""


def commons_notice(kind: str) -> str:
    return f"""This {var(4)} is licensed under {opt("a")} {opt("the")} {opt("terms of the")} Creative Commons {kind} {VERSION}
{opt("International")} {opt("Unported")} License"""


TEXTS = {
    "mit-license": MIT,
    "bsd-2-clause": f"{BSD_OPENING} {BSD_CLOSING}",
    "bsd-3-clause": f"{BSD_OPENING} {BSD_NAMES} {BSD_CLOSING}",
    "isc": ISC,
    "zlib": ZLIB,
    "unlicense": UNLICENSE,
    "apache-2.0-notice": APACHE,
    "gpl-header": gnu_notice("General"),
    "lgpl-header": gnu_notice("Lesser General"),
    "agpl-header": gnu_notice("Affero General"),
    "cc-by-notice": commons_notice("Attribution"),
    "cc-by-sa-notice": commons_notice("Attribution-ShareAlike"),
    "cc-by-nd-notice": commons_notice("Attribution-NoDerivatives"),
    "cc-by-nc-notice": commons_notice("Attribution-NonCommercial"),
    "cc-by-nc-sa-notice": commons_notice("Attribution-NonCommercial-ShareAlike"),
    "cc-by-nc-nd-notice": commons_notice("Attribution-NonCommercial-NoDerivatives"),
}
