"""A plain version of surrogates, entity by entity."""

import hashlib

import regex

from metapep.llm import surrogates as S

START = regex.compile(S.PATTERN)
KINDS = {k: regex.compile(v) for k, v in S.PATTERNS.items()}
TITLE = regex.compile(rf"^(?:(?:{S._TITLES})\.? )?")


def luhn(digits):
    n = [int(x) for x in reversed(digits)]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(n)) % 10 == 0


def kind_of(e):
    return next(k for k in ("email", "secret", "ip", "phone", "ssn", "iban", "card", "name") if k == "name" or KINDS[k].fullmatch(e))


def bare(e):
    return "".join(x for x in e if "0" <= x <= "9")


def canonical(e, kind):
    if kind in ("card", "phone", "ssn"):
        return bare(e)
    if kind in ("email", "iban"):
        return e.replace(" ", "").lower()
    return e[TITLE.match(e).end() :] if kind == "name" else e


def surrogate(e, key):
    kind = kind_of(e)
    if kind == "card" and not luhn(bare(e)):
        return e
    digest = hashlib.sha512(f"{key}|{kind}|{canonical(e, kind)}".encode()).hexdigest()
    number = lambda i, d=digest: int(d[i % 126 : i % 126 + 3], 16)

    def fill(text, alphabets, d=digest):
        own = [next((a for a in alphabets if x in a), x) for x in text]
        return "".join(a[number(i, d) % len(a)] if len(a) > 1 else a for i, a in enumerate(own))

    def put(form, digits):
        it = iter(digits)
        return "".join(next(it) if "0" <= x <= "9" else x for x in form)

    numbers = "".join(str(number(i) % 10) for i in range(126))
    if kind == "email":
        tail = regex.search(r"(?i)([.@]example\.(?:com|org|net)|\.[a-z0-9\-]+)$", e)[0]
        local = e[: len(e) - len(tail)]
        new = fill(local, S.ALPHABETS)
        return (digest[:12].translate(str.maketrans("0123456789abcdef", "bcdfghjklmnpqrst")) if new == local else new) + tail
    if kind == "secret":
        start = regex.match(r"(AKIA|gh[pousr]_|sk-)?", e)[0]
        return start + fill(e[len(start) :], S.ALPHABETS[:3] if start else S.HEX)
    if kind == "ip":
        a, b = map(int, e.split(".")[:2])
        x, y, z = (str(number(k) % 256) for k in (0, 3, 6))
        if a in (0, 10, 127):
            return ".".join((str(a), x, y, z))
        if (a, b) in ((192, 168), (169, 254)):
            return f"{a}.{b}.{x}.{y}"
        if a == 172 and 16 <= b <= 31:
            return f"172.{16 + number(9) % 16}.{x}.{y}"
        first = (224 if a < 240 else 240) + number(9) % 16 if a >= 224 else S._PUBLIC[number(9) % len(S._PUBLIC)]
        return ".".join((str(first), x, y, z))
    if kind == "ssn":
        return put(e, numbers)
    if kind == "phone":
        d, land = bare(e), regex.match(r"\+(\d{1,3})(?=[ .(\-])", e)
        n = len(land[1]) if land else 0
        fixed = len(d) - n == 10 and d[n + 3 : n + 6] == "555"
        return put(e, d[:n] + (numbers[:3] + "555" + numbers[6:10] if fixed else numbers))
    if kind == "card":
        body = numbers[: len(bare(e)) - 1]
        return put(e, body + next(str(c) for c in range(10) if luhn(body + str(c))))
    if kind == "iban":
        body = fill(e.replace(" ", "")[4:], S.ALPHABETS[:3])
        moved = "".join(str(int(x, 36)) for x in body + e[:2] + "00")
        whole = iter(f"{e[:2]}{98 - int(moved) % 97:02d}{body}")
        return "".join(" " if x == " " else next(whole) for x in e)
    own = lambda w, tag: hashlib.sha512(f"{key}|{tag}|{w}".encode()).hexdigest()
    title = TITLE.match(e)[0]
    *given, family = e[len(title) :].split(" ")
    out = fill(family, S.SPOKEN, own(family, "family"))
    if given:
        (w,) = given
        row = next((r for r in S.GIVEN if w in r), None)
        if row:
            new = row[(row.index(w) + 1 + number(0, own(w, "given")) % (len(row) - 1)) % len(row)]
        else:
            new = fill(w[:-1], S.SPOKEN, own(w[:-1], "given")) + w[-1]
        out = f"{new} {out}"
    return title + out


def pseudonymise(text, key):
    """Without the check for collisions."""
    if text is None:
        return None, 0
    n = sum(1 for m in START.finditer(text) if kind_of(m[0]) != "card" or luhn(bare(m[0])))
    return START.sub(lambda m: surrogate(m[0], key), text), n
