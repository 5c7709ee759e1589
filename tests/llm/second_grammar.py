"""A second grammar of labelled sentences, written apart from the training one: other sentences, other names, other draws."""

from __future__ import annotations

import random
import re

GIVEN = "Abigail Tomasz Ngozi Henrik Salma Ruben Ines Kofi Marit Dmitri Leila Oscar Paloma Hugo Sanna Bashir Gwen Matteo Ilse Radu Ayşe Björn Chloé Nuno".split()
FAMILY = "Whitaker Zielinski Adeyemi Lindgren Khoury Castellano Moreira Mensah Haugen Volkov Farahani Bergström Ortega Lambert Nieminen Rahman Pritchard Bianchi Vogel Ionescu Demir Sjöholm Girard Teixeira".split()
STREETS = "Hawthorn Elmwood Juniper Castle Bridge Riverside Maple Chapel".split()
TOWNS = "Ashford Lindau Moravia Kettlewell Grenoble Tampere Salford Bruges".split()

SENTENCES = (
    "The contract names {name} as the only heir.", "{name} and {name} carried the piano upstairs.", "Nominated this year: {name}.", "An obituary for {name} ran on Sunday.", "We regret that {name} cannot attend.", "My manager is {name}, her deputy {name}.", "{name} will chair the panel on Thursday.", "Chief editor: {name}", "{name}'s bicycle was stolen again.",
    "Mrs. {name} rents the upper floor.", "Applause for {name}!", "The bug was introduced by {name}.", "Merge request of {name}", "{name} has left the channel", "Assigned to: {name}", "the complaint that {name} filed", "Guest lecture by Prof. {name}", "Frau {name} ist krank.", "Señor {name} viaja mañana.",
    "Confirmations go out from {email}.", "{name} uses {email} for everything private.", "Login name: {email}", "Whoever finds the keys should contact {email}!", "{email} bounced twice", "Reply-To: {email}", "She signed up as {email}", "Invite {email}, {email} to the room",
    "Leave a message on {phone}.", "{phone} is engaged all day.", "Emergency contact: {name}, {phone}", "Phone ({phone}) preferred", "Telefon: {phone}", "please text {phone} when you arrive", "He gave {phone} as his mobile.", "Bookings under {phone} or {email}",
    "The customs form lists passport {id}.", "Social security number: {id}", "Enter your tax ID ({id}) below.", "Holder of identity card {id}: {name}", "{name} showed a driver's licence, {id}.", "insurance no. {id}", "Personal number {id} does not exist.", "National ID: {id}",
    "The van stops at {address}.", "Home address: {address}", "Collect your key from {address}.", "{name} still lives at {address}.", "Please post the forms to {address}.", "Our branch in {address} opens late.", "Adresse: {address}", "Viewing at {address}, bring shoes.",
    "The cabinet has 14 drawers and 1209 folders.", "Chapter 12 starts on page 2041.", "Update 4.11.2 came out on 2025-11-03.", "Train 4471-22 is late.", "It weighs 12500 kg.", "Kernel 6.8.0-45 boots.", "Batch AX-20991 passed.", "Check md5 9e107d9d372bb6826bd81d3542a419d6 first.", "Grid reference 51.5072, 0.1276", "Server 172.16.254.1 restarted at 03:14:15.",
    "The Terms of Service changed.", "Please Restart Your Computer", "The Annual General Meeting of the Council was short.", "Open Access Journals", "info@library.example answers within a day.", "clone git@git.library.example:maps/tiles.git", "pin left-pad@1.3.0", "He arrived at noon.", "Street food is cheap.", "Only the Data Protection Office knows.",
)


class Draw:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def n(self, count: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(count))

    def name(self) -> str:
        r, a, b = self.r, self.r.choice(GIVEN), self.r.choice(FAMILY)
        return r.choice((f"{a} {b}", f"{a} {b}", f"{a} {r.choice('ABEKLMT')}. {b}", f"{a[0]}. {b}", f"{a} {b}-{r.choice(FAMILY)}", f"{a} van {b}", f"{a}-{r.choice(GIVEN)} {b}"))

    def email(self) -> str:
        r, a, b = self.r, self.r.choice(GIVEN[:18]).lower(), self.r.choice(FAMILY[:10]).lower()
        a, b = (re.sub(r"[^a-z]", "o", x) for x in (a, b))
        host = r.choice(("posteo.example", "studio.example.net", "mx.invalid"))
        return r.choice((f"{a}.{b}@{host}", f"{a[0]}{b}@{host}", f"{b}{r.randint(2, 80)}@{host}", f"{a}.{b} (at) {host.replace('.', ' (dot) ')}", f"{a}+lists@{host}", f"{a}[at]{host}"))

    def phone(self) -> str:
        r, n = self.r, self.n
        return r.choice((f"+{r.randint(31, 48)} {n(2)} {n(3)} {n(4)}", f"({r.randint(200, 989)}) {n(3)}-{n(4)}", f"{r.randint(200, 989)}-{n(3)}-{n(4)}", f"+1 {n(3)} {n(3)} {n(4)}", f"01{n(2)} {n(3)} {n(4)}", f"+44 7{n(3)} {n(6)}", f"06 {n(2)} {n(2)} {n(2)} {n(2)}"))

    def id(self) -> str:
        r, n = self.r, self.n
        a, b = r.choice("CGHJKP"), r.choice("ABCD")
        return r.choice((f"{n(3)}-{n(2)}-{n(4)}", f"{a}{n(8)}", f"{a}{b}{n(6)}{b}", f"{n(6)}-{n(4)}", f"{n(8)}{a}", f"{n(2)} {n(3)} {n(3)} {n(3)}", f"{a}{b}{n(7)}"))

    def address(self) -> str:
        r, n, town, s = self.r, str(self.r.randint(1, 180)), self.r.choice(TOWNS), self.r.choice(STREETS)
        return r.choice((f"{n} {s} {r.choice(('Street', 'Road', 'Lane', 'Avenue'))}, {town} {self.n(5)}", f"{n} {s} {r.choice(('Street', 'Crescent', 'Road'))}, {town}", f"{s}straße {n}, {self.n(5)} {town}", f"{n} rue de {town}, {self.n(5)} {town}", f"PO Box {n}, {town}", f"Flat {r.randint(1, 9)}, {n} {s} Gardens, {town} SW{r.randint(1, 9)} {r.randint(1, 9)}AB"))


KIND = {"name": "name", "email": "email", "phone": "phone", "id": "id_number", "address": "address"}


def labelled(count: int, seed: int) -> list[tuple[str, set[tuple[str, int, int]]]]:
    d, out = Draw(seed), []
    for _ in range(count):
        text, gold = "", set()
        for template in d.r.sample(SENTENCES, d.r.choice((1, 1, 2, 3))):
            for part in re.split(r"(\{\w+\})", template):
                if part[:1] == "{":
                    item = getattr(d, part[1:-1])()
                    gold.add((KIND[part[1:-1]], len(text), len(text) + len(item)))
                    text += item
                else:
                    text += part
            text += d.r.choice(("\n", "\n\n") if text[-1:] not in ".!" else (" ", "\n"))
        out.append((text, gold))
    return out
