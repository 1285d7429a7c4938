"""Printed lines put together from the blocks of the grammar, with the kind each must have."""

from quirework.functions.grammar import CITY, DOC_FULL, DOC_START, DOC_TO_ADDR, DOC_TO_OFF, STATE, UNKNOWN

SYLLABLES = "bel cro dun fal gar hol jun kes lor mid nor pel quin rud sten tarn umb ves wex yar zin".split()


def word(rng, most=3):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, most + 1))).capitalize()


def number(rng, below):
    return str(rng.randrange(1, below))


def name(rng):
    n = f"{word(rng)}, {rng.choice([word(rng), word(rng, 1)[0] + '.', f'{word(rng)} {word(rng, 1)[0]}.'])}"
    return n.upper() if rng.random() < 0.4 else n


def school(rng):
    return f"{rng.choice(['Ala.', 'Ky.', 'Ohio ', 'N.Y.', 'Md.'])}{number(rng, 30)},'{rng.randrange(60, 99)}"


def place(rng):
    return rng.choice([f"{number(rng, 900)} {rng.choice(['', 'N. ', 'W. '])}{word(rng)} {rng.choice(['St.', 'Ave.', 'Pl.'])}", f"{word(rng)} Bldg.", f"{number(rng, 99)}½ {word(rng)} Rd."])


def head(rng):
    """Name, marks and schools up to the semicolon behind them."""
    schools = rng.choice(["◊", school(rng), f"{school(rng)}, {school(rng)}"])
    return name(rng) + rng.choice(["", " (col.)"]) + rng.choice(["", f" (b'{rng.randrange(30, 90)})"]) + rng.choice(["-", "⊕-", " - ", "E-"]) + schools + ";"


def doctor(rng, address=None, office=None, tail=None):
    """The parts of an entry, each but the last ending in a semicolon, and its kind; a choice for what is None."""
    pick = lambda given: rng.random() < 0.5 if given is None else given
    address, office, tail = pick(address), pick(office), pick(tail)
    parts = [head(rng), rng.choice(["(l 0{});", "(l {}t);", "(♁);"]).replace("{}t", "t").format(rng.randrange(1, 9))]
    if rng.random() < 0.2:
        parts.append("not in practice;")
    parts += [f"{place(rng)};"] if address else []
    parts += [f"{rng.choice(['office', 'of- fice'])}, {place(rng)};"] if office else []
    parts += [f"{x};" for x in (rng.choice(["9-11", "8-10, 2-4", "until 9"]), rng.choice(["(A6)", "(B12,C3)"]), rng.choice(["S", "Ob", "U★", "Path"]))[: rng.randrange(1, 4)]] if tail else []
    parts[-1] = parts[-1].rstrip(";")
    return parts, DOC_FULL if tail or not (address or office) else DOC_TO_OFF if office else DOC_TO_ADDR


def city(rng):
    n, county = f"{word(rng)} {word(rng)}", word(rng)
    line = f"{n}, {rng.choice(['-', number(rng, 900), f'{number(rng, 90)},{rng.randrange(100, 999)}'])}, {county}"
    return line.upper() if rng.random() < 0.4 else line


def line(rng):
    """A line of any kind and its kind."""
    kind = rng.choice([STATE, CITY, DOC_START, UNKNOWN, "doctor", "doctor", "doctor"])
    if kind == "doctor":
        parts, kind = doctor(rng)
        return " ".join(parts), kind
    if kind == UNKNOWN:
        return rng.choice([number(rng, 9999), f"{name(rng)}- (l 0{number(rng, 9)})", "", f"({word(rng).lower()};"]), UNKNOWN
    return {STATE: f"{word(rng)} {word(rng)}".upper(), CITY: city(rng), DOC_START: rng.choice([head(rng), head(rng) + " (l 9"])}[kind], kind
