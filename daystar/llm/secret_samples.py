"""Labelled samples for the secret scan: random strings, and identifiers put together from words."""

from __future__ import annotations

import random

# Words that identifiers are made of.
WORDS = """
abstract access account action active address admin agent alias align alpha analysis apache app archive array async
author backup balance base batch bean binary block bootstrap branch bridge broker browser buffer build builtin bundle
button byte cache call catalog channel charset check child class client cluster code collection column command commit
common compiler component config connection console const container content context controller copy core count crash
create current cursor custom data database date debug decode default delete dependency deploy device dialog directory
disk document domain driver dynamic element embedded encode engine entity entry environment error event example
exception execution expect export expression express external factory failure feature field file filter find flag folder
format frame free function gateway general generator github global gnu graph group handler hash header health helper
history home host identifier image implementation import index info initial input insert install instance integer
interface internal item job json kernel key label language launch layer layout level lib library license limit line
link linux list listener load local location lock log login machine manager map master match memory merge message
method metric mode model module monitor mount name network next node notification null number object offset open
operation option order output owner package page parent parse partition password path pattern payment permission
platform plugin point policy pool port prefix primary print private process product profile project property protocol
provider proxy public python query queue random range read record register release remote report repository request
resource response result retry return root route row rule runtime sample schema scope script search secret security
select sequence server service session setting share signal simple single singleton size socket software source spark
spdx sql stack stage start state static status storage store stream string style sub submit support switch symbol
sync system table target task template test text thread time timer title token tool topic total track transaction
transfer transform tree trigger type unicode unique unit unknown update upload url user util valid validation value
variable vector vendor version video view virtual visible volume wait warning web widget window word worker workspace
write wrapper xml yarn zone
""".split()
_SHORT = "utf8 x86 64 v1 v2 ci io id ui db fs os api 16 32 128 2024 i18n py js tmp usr var opt org com net en us".split()
# Alphabets that keys are drawn from.
_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "upper hex": _DIGITS + "ABCDEF",
    "lower": _LOWER,
    "lower and digits": _LOWER + _DIGITS,
    "upper and digits": _LOWER.upper() + _DIGITS,
    "letters": _LOWER + _LOWER.upper(),
    "base62": _LOWER + _LOWER.upper() + _DIGITS,
    "base64": _LOWER + _LOWER.upper() + _DIGITS + "+/",
    "url-safe base64": _LOWER + _LOWER.upper() + _DIGITS + "-_",
}


def words(held_out):
    """Every fifth word is kept for the held-out sample, which knows all of them."""
    return WORDS if held_out else [word for at, word in enumerate(WORDS) if at % 5]


def identifier(draw, pool):
    """An ordinary identifier: a code name, a path, a package, a locale, a date."""
    kind = draw.randrange(10)
    if kind == 0:
        day = f"{draw.randint(1990, 2030)}-{draw.randint(1, 12):02d}-{draw.randint(1, 28):02d}"
        clock = f"{draw.randint(0, 23):02d}-{draw.randint(0, 59):02d}-{draw.randint(0, 59):02d}"
        return day + draw.choice(["T" + clock + "Z", "-" + clock, "_" + draw.choice(pool), "T" + clock])
    parts = draw.choices(pool, k=draw.randint(2, 5))
    if draw.random() < 0.3:
        parts.insert(draw.randrange(len(parts) + 1), draw.choice(_SHORT))
    if kind in (1, 2):
        name = "".join(part.capitalize() for part in parts)
        return name if kind == 1 else name[:1].lower() + name[1:]
    if kind == 3:
        return draw.choice(["", "", "__", "_"]) + "_".join(parts)
    if kind == 4:
        return "_".join(parts).upper()
    if kind == 5:
        return "-".join(parts)
    if kind == 6:
        return "-".join(part.capitalize() for part in parts)
    if kind in (7, 8):
        return draw.choice(["", "/"]) + "/".join(parts) + draw.choice(["", "", "/" + draw.choice(pool).upper()])
    return "/".join([*parts[:2], "_".join(parts[2:]) or "src"])


def labelled(n, least, seed, held_out=False):
    """`n` strings of each kind, (text, alphabet or None for an identifier), of `least` or more characters."""
    draw, pool, found = random.Random(seed), words(held_out), []
    names = list(ALPHABETS)
    for at in range(n):
        name = names[at % len(names)]
        length = draw.choice([20, 24, 32, 40, 64]) if held_out else draw.randint(least, 64)
        found.append(("".join(draw.choices(ALPHABETS[name], k=length)), name))
        while len(text := identifier(draw, pool)) < least:
            pass
        found.append((text, None))
    return found
