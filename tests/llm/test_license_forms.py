"""Common real forms of known licences, and the scan against a plain Python version of its canonical form."""

import hashlib
import random

import regex

from llm_fixtures import llm, make_docs  # noqa: F401
from ledgerline.llm import license_scan as L


def text_of(name):
    return max((t for n, t in L.known_texts() if n == name), key=len)


def found(make_docs, llm, texts):
    got = {r.doc_id: r.license_id for r in L.license_scan(make_docs(list(enumerate(texts))), L.known_digests(llm)).collect()}
    return [got[i] for i in range(len(texts))]


def real_forms():
    mit, isc, apache, gpl, bsd = (text_of(n) for n in ("MIT", "ISC", "Apache-2.0", "GPL-2.0-only", "BSD-3-Clause"))
    notice = "Copyright (c) <year> <copyright holders>"
    old_address = gpl.replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA")
    assert old_address != gpl
    named = bsd.replace("the copyright holder nor", "Acme Corp. nor").replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "ACME CORP. AND CONTRIBUTORS") \
               .replace("THE COPYRIGHT HOLDER OR CONTRIBUTORS", "ACME CORP. OR CONTRIBUTORS").replace("Copyright (c) <year>, <owner>", "Copyright (c) 2011-2019, Acme Corp.")
    bullets = bsd.replace("1. Redis", "* Redis").replace("2. Redis", "  * Redis").replace("3. Neither", "   * Neither")
    return [
        (mit, "MIT"), (mit.replace("MIT License", "The MIT License (MIT)"), "MIT"), (mit.replace("MIT License", "The MIT License"), "MIT"),
        (mit.removeprefix("MIT License\n\n"), "MIT"), (mit[mit.index("Permission"):], "MIT"),
        (mit.replace(notice, "Copyright Jane Doe"), "MIT"), (mit.replace(notice, "Copyright Jane Doe, Joe Bloggs and others\nAll rights reserved."), "MIT"),
        (mit.replace("MIT License\n\n" + notice, "Copyright (c) 2020 Jane Doe\n\nMIT License"), "MIT"),
        (mit.replace("THE AUTHORS OR COPYRIGHT HOLDERS BE", "JANE DOE BE"), "MIT"),
        (isc[isc.index("Permission"):], "ISC"), (isc.replace("THE AUTHOR DISCLAIMS", "JANE DOE DISCLAIMS"), "ISC"),
        (apache[:apache.index(L.END_OF_TERMS)], "Apache-2.0"), (apache[:apache.index(L.END_OF_TERMS) + len(L.END_OF_TERMS)], "Apache-2.0"),
        (gpl[:gpl.index("How to Apply")] if "How to Apply" in gpl else gpl[:gpl.index(L.END_OF_TERMS)], "GPL-2.0-only"),
        (old_address, "GPL-2.0-only"), (named, "BSD-3-Clause"), (bullets, "BSD-3-Clause"), (bullets.upper(), "BSD-3-Clause"),
        (bsd.replace("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License'), "BSD-3-Clause"), (bsd.replace("BSD 3-Clause License", "New BSD License"), "BSD-3-Clause"),
        (text_of("Zlib").replace("1. The", "(1) The").removeprefix("zlib License"), "Zlib"),
    ]


def other_texts():
    """Texts that aren't a known licence as a whole."""
    mit, apache, bsd = (text_of(n) for n in ("MIT", "Apache-2.0", "BSD-3-Clause"))
    return ["MIT License", "MIT License\n\n", "The MIT License (MIT)\n!!!", "Copyright Jane Doe", "Copyright 2020 Jane Doe\n\nAll rights reserved.", mit + "\nAlso, pay me.",
            mit.replace("without restriction", "with restriction"), "MIT License, changed\n" + mit[mit.index("Permission"):], apache[: len(apache) // 2],
            apache + "\n\nThird-party software under other terms follows.", bsd.replace("nor the names of its contributors", ""),
            bsd.replace("2. Redistributions", "2. All redistributions"), "copyright is a right\n\nof authors", None, "", "\n©\n"]


def test_common_real_forms(llm, make_docs):
    forms = real_forms()
    got = found(make_docs, llm, [t for t, _ in forms])
    assert [(i, g, w) for i, (g, (_, w)) in enumerate(zip(got, forms)) if g != w] == []


def test_other_texts_stay_unknown(llm, make_docs):
    got = found(make_docs, llm, other_texts())
    assert got == [None] * len(got)


def test_known_texts_stay_apart(llm):
    """No two licences fall together by their canonical form."""
    rows = L.known_digests(llm).collect()
    forms = {(n, f) for n, t in L.known_texts() for f in L.without_appendix(t)}
    by_name = {}
    for name, form in forms:
        by_name.setdefault(plain_canonical(form), set()).add(name)
    assert all(len(names) == 1 for names in by_name.values())
    assert len(rows) == len(by_name)


# ---- the canonical form, step by step over lines and words

_STOP = set("""notice notices owner owners holder holders law laws license licenses licence licences statement statements interest interests disclaimer disclaimers
right rights treaty treaties act acts status and or in on by to the is are for of as with that this permission information protection infringement""".split())

def _words(s):
    return " ".join(regex.findall(r"[\p{L}\p{N}]+", s.lower()))


def _is_notice(lines, i):
    line = lines[i]
    w = _words(line).split()
    if w in (["rights", "reserved"], ["all", "rights", "reserved"]):
        return True
    head = regex.sub(r"^[^\p{L}\p{N}©]*", "", line)
    dated = r"((19|20)\d\d\b|[<\[{][^>\]}]*[>\]}])"
    opened = regex.match(r"^.*?\(c\)", line, regex.I) and regex.match(r"[^\p{L}\p{N}©]*\(c\)\s*(copyright\b|©|" + dated + ")", line, regex.I)
    if head.startswith("©") or opened or regex.match(r"copyright\b[\s:,]*(\(c\)|©|" + dated + ")", head, regex.I):
        return True
    return False


def _is_named(line):
    m = regex.match(r"[^\p{L}\p{N}]*copyright\b[ \t:,]*([^\s:,].{0,119})$", line, regex.I)
    word = m and regex.match(r"\w*", m[1])[0].lower()
    return bool(m) and word not in _STOP


def _named_paragraphs(lines):
    """The numbers of the lines of paragraphs that are notices by name."""
    out, i = set(), 0
    while i < len(lines):
        opens = not any(x.strip() for x in lines[:i]) or not _words(lines[i - 1])
        end = i
        while opens and end < len(lines) and _is_named(lines[end]):
            end += 1
        if end > i and (not any(x.strip() for x in lines[end:]) or not _words(lines[end]) or _words(lines[end]).startswith(("all rights reserved", "rights reserved"))):
            out |= set(range(i, end))
        i = max(end, i + 1)
    return out


def plain_canonical(text):
    lines = (text or "").split("\n")
    named = _named_paragraphs(lines)
    lines = [x for i, x in enumerate(lines) if i not in named and not _is_notice(lines, i)]
    s = _words("\n".join(lines))
    for pattern, to in L.SPELLINGS + L.REPLACED:
        s = regex.sub(pattern, to.replace("$1", r"\1"), s)
    s = s.strip()
    rest = s.removeprefix("the ")
    titles = [t for t in L.TITLES if rest.startswith(t + " ")]
    return rest[len(max(titles, key=len)) + 1:] if titles else s


def test_scan_equals_plain_python(llm, make_docs):
    rnd = random.Random(7)
    texts = [t for t, _ in real_forms()] + other_texts()
    notices = ["Copyright Jane Doe", "(c) 2020 X", "© 1999 Y", "Copyright: [yyyy] [name]", "All rights reserved.", "The MIT License (MIT)", "BSD License", "copyright law applies", "* a licence\n\n1. Redistributions of"]
    for t in [t for t in texts if t and len(t) < 3000]:
        lines = t.split("\n")
        for _ in range(4):
            changed = list(lines)
            for _ in range(rnd.randint(1, 3)):
                changed.insert(rnd.randint(0, len(changed)), rnd.choice(notices + ["", "   "]))
            texts.append("\n".join(changed))
    known = {hashlib.sha256(plain_canonical(f).encode()).hexdigest(): n for n, t in L.known_texts() for f in L.without_appendix(t)}
    want = {}
    for i, t in enumerate(texts):
        digest = hashlib.sha256(plain_canonical(t).encode()).hexdigest()
        want[i] = (digest, known.get(digest))
    got = {r.doc_id: (r.canonical_sha256, r.license_id) for r in L.license_scan(make_docs(list(enumerate(texts))), L.known_digests(llm)).collect()}
    wrong = [(i, texts[i], want[i][1], got[i][1]) for i in want if got[i] != want[i]]
    assert wrong == []
    assert sum(v is not None for _, v in want.values()) > 40
