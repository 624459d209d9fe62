"""Labelled examples of personal data outside the fixed formats, made by rule: contexts x values.

A long number that fails the check of cards is personal only where the words around it say so.
"""

from __future__ import annotations

# kind -> (contexts of personal data, contexts of other things); "_" stands for the value.
CONTEXTS = {
    "number": (
        ["my card is _ and", "account _ at", "paid with visa _,", "bank: _.", "card number _ ", "Konto _ bei"],
        ["the _ was", "and _ ", "ration _ eren", "was _, the", "ISBN _ print", "order # _ sent", "tracking _ by", "serial=_;", "timestamp _ ms", "order _ is", "id/_/x", "$_ in total", "a_b"],
    ),
    "local_phone": (
        ["phone _ or", "call _ now", "tel. _,", "fax: _ ", "my mobile _.", "contact _ today", "Telefon _ ", "reach me at _ or", "tél. _,", "llama al teléfono _ "],
        ["order _ and", "part _ x", "version _ of", "serial=_ ", "date _ to", "about _ kg", "ticket # _ is", "$_ a year", "ISBN _ in", "tracking _ ", "invoice no. _,", "sku _ has"],
    ),
    "national_id": (
        ["SSN _ was", "social security _,", "her number _ is", "tax id _.", "and _ the", "was _ in"],
        ["part _ fits", "order _ of", "serial=_ ", "SKU _ in", "model _ is", "invoice # _ "],
    ),
    "iban": (
        ["IBAN _ is", "bank account _,", "Konto _ bei", "pay to _ by", "and _ the"],
        ["serial=_ ", "part _ of", "order # _ ", "model _ is", "commit _ in", "SKU _ "],
    ),
    "spelled_email": (
        ["mail _ for", "contact _ ", "write to _.", "and _ the"],
        ["version=_ ", "commit=_ ", "order # _ "],
    ),
}
FORMS = {
    "number": (["dddddddddddddddd", "dddd dddd dddd dddd", "dddd-dddd-dddd-dddd", "ddddddddddddddd", "ddddddddddddd"], ["0000000000000000", "1111111111111111", "1000000000000000", "0000-0000-0000-0000"]),
    "local_phone": (
        ["(ddd) ddd-dddd", "ddd-ddd-dddd", "0ddd dddd ddd", "0dd/dddd ddd", "0d dd dd dd dd", "0ddddddddd", "ddd dd dd dd", "0dd / dddddd", "dddddddddd",
         "ddd dddd", "0d.dd.dd.dd.dd", "(0dd) ddddddd", "dddddddd", "ddd ddd ddd"],
        ["000-000-0000", "2024-05-1d", "2019/11/2d", "1d.03.2021", "1 500 000", "20240512", "0000000", "1d 000 000", "2001 2009"],
    ),
    "national_id": (["ddd-dd-dddd"], ["000-00-0000"]),
    "iban": (["DEdd dddd dddd dddd dddd dd", "FRdd dddd dddd dddd dddd dddd ddd", "ESdddddddddddddddddddddd", "NLdd ABNA dddd dddd dd"], ["XQdddddddddddd", "ZZdd ABCD EFGH IJKL"]),
    "spelled_email": (["jane.doe (at) mail.example.com", "info[at]site.org", "joe (at) example (dot) com", "abc1[at]post.net"], []),
}
# Without any word around them, only forms that nothing else is written in are personal.
ALONE = {"local_phone": (["and _ for", "was _ in", "the _ eren", "- _ "], ["(ddd) ddd-dddd", "0ddd dddd ddd", "0d dd dd dd dd", "0d.dd.dd.dd.dd", "0dd / dddddd"], ["dddddddd", "ddddddd", "dddddddddd", "ddd ddd ddd", "2024-05-1d", "1 500 000"])}
ROUNDS = 3


def filled(form: str, seed: int) -> str:
    """Digits for every d, from a fixed generator."""
    out = []
    for place, letter in enumerate(form):
        seed = (seed * 1103515245 + 12345 + place) % 2**31
        out.append(str(seed >> 16)[-1] if letter == "d" else letter)
    return "".join(out)


def EXAMPLES() -> list[dict]:
    """Values of personal form in personal contexts are 1; in other contexts, or of forms nobody has, 0."""
    found = []
    for turn in range(ROUNDS):
        for kind, (personal, other) in CONTEXTS.items():
            real, empty = FORMS[kind]
            for i, context in enumerate(personal + other):
                before, _, after = context.partition("_")
                values = [(form, float(i < len(personal))) for form in real] + [(form, 0.0) for form in empty]
                for k, (form, label) in enumerate(values):
                    value = form if kind == "spelled_email" else filled(form, 7919 * turn + 104729 * i + 31 * k)
                    found.append({"kind": kind, "before": before, "value": value, "after": after, "label": label})
        for kind, (contexts, real, empty) in ALONE.items():
            for i, context in enumerate(contexts):
                before, _, after = context.partition("_")
                for k, form in enumerate((*real, *empty)):
                    value = filled(form, 6007 * turn + 7_368_787 * i + 37 * k)
                    found.append({"kind": kind, "before": before, "value": value, "after": after, "label": float(k < len(real))})
    return found
