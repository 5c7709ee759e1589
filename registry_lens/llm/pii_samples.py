"""Labelled sentences for training: a grammar of everyday prose with invented personal items.

The sentences were written for this module, from general knowledge of how letters, forms,
support tickets, commit logs and notices look. Nothing here is read or taken from any
table, and a test holds that no sentence shares five words in a row with the advisories.
Names, streets and numbers are drawn from a seeded generator, so the model is the same
wherever it is trained.
"""

from __future__ import annotations

import random
import re

from registry_lens.llm.pii_model import NAME_WORDS

_ONSET = "b br c ch d dr f fl g gr h j k kl l m n p pr ph qu r s sh sk st t th tr v w z".split()
_VOWEL = "a e i o u ae ei ou ia é ö ü á ø å ı ō ę".split()
_CODA = "l n r s m rt nd lk st x ck ng ş ć".split()
_TOWN_END = "ford burg ham stad mouth ville dorf minster holm wick ton bury bach by".split()
_PLAIN = "lamp river stone cable branch copper meadow violet timber marble wander socket kettle anchor pebble".split()
_DOMAINS = "example.com mail.example.org uni.example.net inbox.test post.invalid corp.example hr.corp.example alumni.example.edu".split()
_ORGS = (
    "Northwind Labs", "Larkfield Hospital", "the Bluebird Research Group", "Orbital Software GmbH", "Pinegate Response", "the Amber audit crew", "Fabrikam Inc.", "Open Source Foundation", "Quay Security Team", "Harbour Bank plc",
    "the Department of Transport", "University of Westmark", "Lindqvist & Partners Ltd", "Umbrella Consulting", "Stellar Studios", "the Elm School Committee", "Delta Logistics AG", "Nordic Press Agency", "the Parish Council", "Green River Press",
)
_FIRST = "Maria Anna James Peter Olga Ivan Chen Wei Fatima Omar Lucas Emma Noah Hannah Yuki Ravi Priya Diego Lucía Søren Łukasz Zoë Élodie Jürgen Aoife Kwame".split()
_LAST = "Smith Jones Müller García Rossi Novak Kowalski Okafor Haddad Tanaka Singh Nguyen O'Neill D'Amico MacLeod Lefèvre Åberg Yılmaz Petrov Silva".split()


class Generator:
    """Draws items and fills templates."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def syllables(self, n: int) -> str:
        r = self.r
        return "".join(r.choice(_ONSET) + r.choice(_VOWEL if r.random() < 0.25 else _VOWEL[:5]) for _ in range(n)) + (r.choice(_CODA) if r.random() < 0.7 else "")

    def word(self) -> str:
        return self.syllables(self.r.choice((1, 2, 2, 3))).capitalize()

    def given(self) -> str:
        if self.r.random() < 0.04:
            return self.r.choice(sorted(NAME_WORDS)).capitalize()
        first = self.r.choice(_FIRST) if self.r.random() < 0.25 else self.word()
        return f"{first}-{self.word()}" if self.r.random() < 0.12 else first

    def family(self) -> str:
        if self.r.random() < 0.04:
            return self.r.choice(sorted(NAME_WORDS)).capitalize()
        name = self.r.choice(_LAST) if self.r.random() < 0.25 else self.word()
        if self.r.random() < 0.04:
            name = f"{self.r.choice(('O', 'D', 'L'))}{self.r.choice(chr(39) + '’')}{name}"
        if self.r.random() < 0.15:
            name = f"{name}-{self.word()}"
        if self.r.random() < 0.17:
            name = f"{self.r.choice(('von', 'van', 'de la', 'von der', 'al', 'el', 'bint', 'bin', 'van den', 'van der', 'de', 'ibn', 'del', 'di', 'du', 'dos'))} {name}"
        return name

    def name(self) -> str:
        r, form = self.r, self.r.random()
        if form < 0.55:
            return f"{self.given()} {self.family()}" if r.random() < 0.95 else " ".join(w.capitalize() for w in r.sample(sorted(NAME_WORDS), 2))
        if form < 0.66:
            return f"{self.given()} {self.word()[0]}. {self.family()}"
        if form < 0.7:
            return f"{self.given()} {self.given()} {self.family()}"
        if form < 0.81:
            gap = "" if r.random() < 0.15 else " "
            return f"{self.word()[0]}.{gap}{self.word()[0]}. {self.family()}" if r.random() < 0.6 else f"{self.word()[0]}. {self.family()}"
        if form < 0.92:
            return f"{self.word()}{'-' + self.word() if r.random() < 0.2 else ''}, {self.given()}{' ' + self.word()[0] + '.' if r.random() < 0.1 else ''}"
        return f"{self.given()} {self.word()}{'-' + self.word() if r.random() < 0.3 else ''}".upper()

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def phone(self) -> str:
        d, r = self.digits, self.r
        return r.choice((
            lambda: f"+{r.randint(1, 98)} {d(2)} {d(5)} {d(3)}", lambda: f"00{r.randint(30, 98)}-{d(2)}-{d(5)}-{d(3)}", lambda: f"00{r.randint(30, 98)} {d(3)} {d(6)}", lambda: f"+1 ({d(3)}) {d(3)}-{d(4)}", lambda: f"{r.randint(2, 9)}{d(2)}-{d(3)}-{d(4)}",
            lambda: f"({r.randint(2, 9)}{d(2)}) {d(3)} {d(4)}", lambda: f"({r.randint(2, 9)}{d(2)}) {d(3)}-{d(4)}", lambda: f"{r.randint(2, 9)}{d(2)}-{d(4)}", lambda: f"+1{d(10)}", lambda: f"+{r.randint(30, 98)}{d(9)}", lambda: f"+1.{d(3)}.{d(3)}.{d(4)}", lambda: f"+1-{d(3)}-{d(3)}-{d(4)}",
            lambda: f"0{r.randint(1, 9)}.{d(2)}.{d(2)}.{d(2)}.{d(2)}", lambda: f"0{r.randint(1, 9)} {d(2)} {d(2)} {d(2)} {d(2)}", lambda: f"+33 {r.randint(1, 9)} {d(2)} {d(2)} {d(2)} {d(2)}", lambda: f"+44 (0){d(2)} {d(4)} {d(4)}", lambda: f"+44 {d(4)} {d(6)}", lambda: f"0{d(4)} {d(3)} {d(3)}", lambda: f"0{d(4)} {d(6)}",
            lambda: f"+{r.randint(10, 98)} {d(3)} {d(3)} {d(3)}", lambda: f"0{d(2)}-{d(4)}-{d(4)}", lambda: f"0{d(2)}/{d(7)}", lambda: f"1-800-{d(3)}-{d(4)}", lambda: f"{r.randint(2, 9)}{d(2)}.{d(3)}.{d(4)}",
        ))()

    def identity(self) -> str:
        d, r = self.digits, self.r
        letter = lambda: r.choice("ABCDEFGHKLMNPRSTXYZ")
        return r.choice((
            lambda: f"{letter()}{letter()}{d(6)}{letter()}", lambda: f"{letter()}{letter()} {d(2)} {d(2)} {d(2)} {letter()}", lambda: f"{d(3)}-{d(2)}-{d(4)}", lambda: f"{d(3)} {d(2)} {d(4)}", lambda: f"{d(6)}-{d(4)}", lambda: f"{d(6)}+{d(4)}", lambda: f"{letter()}{d(7)}", lambda: f"{letter()}{d(8)}",
            lambda: f"{letter()}{d(2)}{letter()}{d(2)}{letter()}{d(3)}", lambda: f"{letter()}{d(2)}{letter()}{d(2)}{letter()}{d(2)}", lambda: f"{d(2)} {d(3)} {d(3)} {d(3)}", lambda: f"{letter()}{letter()}{d(7)}", lambda: f"{d(8)}{letter()}", lambda: f"{d(8)}-{letter()}", lambda: f"{letter()}{d(3)}{letter()}{letter()}{d(4)}",
        ))()

    def local_part(self) -> str:
        r = self.r
        a, b = (re.sub(r"[^a-z]", "e", self.word().lower()) for _ in range(2))
        return r.choice((f"{a}.{b}", f"{a}_{b}", f"{a[0]}{b}", f"{b}{r.randint(1, 99)}", f"{a}+{r.choice(_PLAIN)}", f"{a}+{b[:3]}{r.randint(0, 99)}", f"{a}-{b}", f"{a.title()}.{b.title()}", a, f"{b}.{a[0]}"))

    def email(self) -> str:
        r, local = self.r, self.local_part()
        domain = r.choice(_DOMAINS)
        if r.random() < 0.1:
            return f"{local}@{domain}".upper()
        if r.random() < 0.6:
            return f"{local}@{domain}"
        at = r.choice((" at ", " AT ", "(at)", " (at) ", "[at]", " [at] ", " <at> ", " {at} ", "(@)"))
        dot = r.choice((" dot ", "(dot)", " [dot] ", "[dot]", " (dot) ", "."))
        if at.strip() in ("at", "AT") and dot == ".":
            dot = " dot "
        return local + at + domain.replace(".", dot)

    def encoded_email(self) -> str:
        """As the query of a URL has it."""
        plus = self.r.choice(("+", "%2B"))
        return f"{self.local_part().replace('+', plus)}%40{self.r.choice(_DOMAINS)}"

    def role_email(self) -> str:
        r = self.r
        local = r.choice(("security", "abuse", "support", "info", "admin", "noreply", "no-reply", "postmaster", "team", "press", "billing", "jobs", "help", "webmaster", "sales"))
        return f"{local}@{r.choice(_DOMAINS)}"

    def clone_login(self) -> str:
        r = self.r
        return r.choice((f"git@git.{r.choice(_DOMAINS)}:{r.choice(_PLAIN)}/{r.choice(_PLAIN)}.git", f"git@code.{r.choice(_DOMAINS)}:{r.choice(_PLAIN)}.git", f"ssh://hg@hg.{r.choice(_DOMAINS)}/{r.choice(_PLAIN)}", f"svn@svn.{r.choice(_DOMAINS)}", f"git@git.{r.choice(_DOMAINS)}"))

    def town(self) -> str:
        r, town = self.r, self.syllables(1).capitalize() + self.r.choice(_TOWN_END)
        x = r.random()
        return f"{r.choice(('Saint', 'Bad', 'Port', 'Ober', 'Klein'))}-{town.capitalize()}" if x < 0.12 else f"{r.choice(('New', 'San', 'Bad', 'North', 'Le'))} {town}" if x < 0.2 else town

    def address(self) -> str:
        r, d, n = self.r, self.digits, str(self.r.randint(1, 240)) + (self.r.choice("abc") if self.r.random() < 0.15 else "")
        name = self.word() if r.random() < 0.7 else r.choice(("Station", "Church", "Mill", "Park", "Victoria", "Old Mill", "Long Acre", "Bahnhof", "Linden", "Mayor"))
        kind = r.randrange(6)
        comma = ", " if r.random() < 0.7 else "\n"
        uk = f"{r.choice('ABLZ')}{r.choice('ABLZ')}{r.randint(1, 9)} {r.randint(1, 9)}{r.choice('ABQX')}{r.choice('ABQX')}"
        if kind == 0:
            street = f"{n} {name} {r.choice(('Street', 'Lane', 'Road', 'Close', 'Avenue', 'Drive', 'Court', 'Square', 'Way', 'Gardens', 'Crescent', 'Hill'))}"
        elif kind == 1:
            street = f"{n} {name} {r.choice(('St.', 'Ave.', 'Blvd', 'Rd.', 'Blvd.', 'Ln', 'Rd', 'Ave', 'Way', 'Ct.'))}"
        elif kind == 2:
            street = f"{n}{r.choice((',', '', '', ' bis'))} {r.choice(('rue', 'avenue', 'place', 'quai', 'chemin', 'boulevard'))} {r.choice(('des ', 'de la ', 'du ', 'de ', ''))}{name.split()[0]}{r.choice(('', 's'))}"
            return f"{street}{comma}{d(5)} {self.town()}" if r.random() < 0.75 else f"{street}, {self.town()}"
        elif kind == 3:
            road = r.choice(("straße", "weg", "gasse", "allee", "platz", "strasse", "ring", "ufer"))
            street = f"{name.split()[0]}{road} {n}" if r.random() < 0.8 else f"{r.choice(('Alte', 'Lange', 'Kleine'))} {name.split()[0]}{road} {n}"
            return f"{street}{comma}{r.choice(('', '', 'D-'))}{d(5)} {self.town()}" if r.random() < 0.65 else f"{street}, {self.town()}"
        elif kind == 4:
            road = f"{r.choice(('Calle', 'Avenida', 'Plaza', 'Via', 'Camino'))} {r.choice(('', '', 'de la ', 'del '))}{name.split()[0]} {n}"
            floor = r.choice((f", {r.randint(1, 9)}.º {r.choice('ABCD')}", f", {r.randint(1, 9)}º{r.choice('ABCD')}", "", ""))
            return f"{road}{floor}, {r.choice(('', d(5) + ' '))}{self.town()}"
        else:
            return r.choice((f"P.O. Box {n}, {self.town()}", f"PO Box {r.randint(10, 9999)}, {self.town()} {d(5)}", f"Postfach {r.randint(10, 9999)}, {d(5)} {self.town()}", f"{r.choice(('Flat', 'Apartment', 'Unit', 'Suite'))} {r.randint(1, 30)}, {n} {name} {r.choice(('Terrace', 'House Road', 'Street', 'Court'))}, {self.town()} {uk}"))
        tail = r.random()
        if tail < 0.35:
            return f"{street}, {self.town()} {d(5)}"
        if tail < 0.45:
            return f"{street}, {self.town()} {uk}"
        if tail < 0.55:
            return f"{street}, {self.town()}, {r.choice(('CA', 'NY', 'TX', 'WA'))} {d(5)}"
        return f"{street}\n{self.town()} {d(5)}" if tail < 0.75 else f"{street}, {self.town()}" if tail < 0.87 else street.rstrip(".")

    def package(self) -> str:
        r = self.r
        name = r.choice("-_.").join(r.sample(_PLAIN, r.randint(2, 3)) + [r.choice(("x2", "core", "cli", "7k", "12"))])
        return f"@{r.choice(_PLAIN)}/{name}" if r.random() < 0.4 else name

    def version(self) -> str:
        return ".".join(str(self.r.randint(0, 30)) for _ in range(3))


#: {N} name, {E} email, {U} email in a URL, {P} phone, {I} identity number, {A} address are labelled; lower-case fields are not.
TEXTS = (
    # letters, notices and forms
    "Dear {N}, your parcel is waiting at the counter.", "Hello {N},\nthank you for the order of last week.", "Yours sincerely,\n{N}", "Kind regards\n{N}\n{P}", "Cheers, {N}", "Signed: {N}, {A}", "Patient: {N}\nBorn: 19{two}-11-{two}\nInsurance number: {I}", "Tenant {N} has moved from {A} to {A}.",
    "The applicant, {N}, gave {A} as a permanent home.", "Full name: {N}\nE-mail: {E}\nPhone: {P}\nAddress: {A}", "name={N}; mail={E}; mobile={P}", "{N} | {E} | {P}", "{N},{I},{E}", "{N}\t{P}\t{A}", "Guests tonight are {N}, {N} and {N}.", "Minutes taken by {N}; present were {N} and {N}.", "Our teacher {N} retires in June.",
    "Mr. {N} and Mrs. {N} run the bakery.", "Prof. {N} will open the exhibition.", "Dr. {N} is on holiday, please see Dr. {N}.", "We met {N} at the fair.", "{N} phoned twice this morning.", "{N} has paid in full.", "{N} was born in a small town.", "Is {N} still working for {org}?", "{N} joined {org} in the spring.",
    "Nobody but {N} knew the combination.", "A letter for {N} came back unopened.", "It was {N} who fixed the fence.", "{N}'s dog ran off.", "I borrowed {N}'s ladder and never gave it back.", "She told {N} everything.", "The judges praised {N} for the drawing.", "Photo by {N}.", "Text and drawings: {N}", "Translated into Dutch by {N}", "Interview with {N}", "In memory of {N}",
    "Please ask for {N} at the desk.", "Ping {N} about it.", "Ping {N} tomorrow, or ask {E}.", "ping {N}", "Ask {N} first.", "Tell {N} or {N}.", "You may also speak to {N} or to {N}.", "with friendly help from {N}", "According to a neighbour, {N} left early.", "From: {N} <{E}>\nTo: {N} <{E}>\nSubject: lunch", "On Tuesday {N} <{E}> wrote:", "cc {N} ({E}) and {N} ({E})",
    # mail, phone, numbers
    "Forward the bill to {E} please.", "My new mail is {E}, the old one no longer works.", "Reach us under {E} or {P}.", "You can drop me a line: {E}", "Alternatively use {E}.", "Spam came in from {E} and {E} all week.", "{E} is not a member of this list.", "Subscribe {E} to the weekly letter", "Bounced: {E}", "{E} complained about noise", "{E} failed to log in.", "{E} owes us a reply", "{E} (spam)", "{E} - old", "* {E}", "1. {N}, {E}", "deputy {N} signed", "His brother {N} came too.", "This week: {N}.", "Winner: {N}", "our neighbour {N}", "her lawyer {N}", "his assistant {N} and the cook {N}", "user {E} signed in", "To unsubscribe visit https://{plain}.example/stop?mail={U}",
    "The tracker called https://{plain}.test/px?id={four}&to={U}&k={hex}", "GET /track?user={U}&v={ver} HTTP/1.1", "Link: https://{plain}.example/{plain}?u={U}", "Ring {P} after six.", "Switchboard {P}, direct line {P}.", "Tel.: {P}", "Fax {P}", "Her number is {P}.", "If nobody answers, dial {P} instead.", "Text {P} to confirm the appointment.",
    "WhatsApp: {P} ({N})", "the help line ({P}) is open all day", "missed call from {P}", "Handynummer {P}", "Tél. : {P}", "Mein Telefon: {P}", "They could be reached on {P} until noon.", "The driver left {P} as a callback number.", "Office hours nine to five, {P}.",
    "Passport {I} expires next year.", "passport number: {I}", "Her social security number, {I}, was printed on the form.", "SSN: {I}", "NI number {I}", "Tax number {I} was rejected by the portal.", "The licence of the driver ({I}) was revoked.", "National insurance {I}", "Identity card {I}, issued in {town}", "DNI {I}", "Steuernummer {I}", "Ausweis Nr. {I} liegt vor.",
    "id document {I} has been checked", "He wrote his identification number ({I}) on the cover.", "Please quote your personal number {I} whenever you write.", "{N}, ID {I}", "Resident permit {I} of {N}", "A photo of card {I} was attached.", "{I} is the tax identifier of the buyer.", "{I} turned out to be a real passport.", "We found {I} in the log, a social security number.",
    "The scan shows {I} and {I}.", "row {three}: {N};{I};{P};{E}", "\"{N}\",\"{I}\",\"{P}\"", "'{I}' was left in a comment", "An old backup contained {I} in plain text.", "test data with the number {I} must go",
    # addresses
    "Ship it to {A}.", "Our shop is at {A}", "Deliveries: {A}", "{N}, {A}", "{N}\n{A}", "We have moved! New address: {A}", "The office at {A} stays closed on Friday.", "Meet me in front of {A} at noon.", "Billing address ({A}) is missing a postcode.", "She lives at {A}, next to the bridge.", "Meine Adresse lautet {A}.", "Sie wohnt in der {A}.",
    "Nous habitons {A}.", "Vivo en {A}.", "Send cheques to {A}; we have no bank account.", "a house in {A} was sold", "Return to sender: {A}", "Visit {org}, {A}.", "The parcel for {A} got lost, call {P}.", "Parking is behind {A}.", "Impressum: {N}, {A}, {E}", "Registered seat: {A}",
    "Find us at {A}, tel. {P} and fax {P}.", "tel. {P} or {E}", "The card shows tel. {P} and {A}.", "Both {P} and {P} ring in the kitchen.", "tel {P} and ask", "phone {P}, {A}", "{P} and {P} are out of service.", "Old signs give phone {P} and mail {E}.", "The door plate reads {A}. Nobody opened.", "They moved to {A}. The bell is broken.",
    # other languages
    "Herr {N} rief gestern an.", "Frau {N} hat gekündigt.", "Liebe {N}, vielen Dank für den Brief.", "Bitte melden Sie sich bei {N} unter {P}.", "Mit freundlichen Grüßen\n{N}", "Monsieur {N} est parti.", "Merci à {N} pour son aide.", "Écrivez à {E}.", "Appelez {N} au {P}.", "La señora {N} llegó tarde.", "Gracias a {N} por todo.", "Llame a {N}, {P}", "Escriba a {E}.", "De heer {N} woont in {A}.",
    # software prose of its own
    "Signed-off-by: {N} <{E}>", "Co-developed-by: {N} <{E}>", "Author: {N} <{E}>\nDate:   Mon Mar {two} 09:{two}:00", "Copyright (c) 20{two} {N}", "Copyright 20{two} {N} <{E}>", "maintained by {N} since 20{two}", "Patch written by {N}, reviewed by {N}", "thanks @{login} and {N}", "{N} reported that {pkg} crashes", "{N} discovered a hole in {pkg}", "{N} noticed it first.", "Kudos to {N} of {org}",
    "Found by {N} ({org})", "{N} of {org} wrote a patch.", "{N} from {org} and {N} from {org} disclosed it together.", "{pkg} mails your files to {E}", "the script posts the key ring to {E}", "secrets were copied to https://{plain}.invalid/in?m={U}", "\"author\": \"{N} <{E}> (https://{plain}.example)\"", "author {N}", "// TODO({N}): remove", "% by {N}, {E}", "pull from {clone}", "remote: {clone}", "We asked {N} and {role} for comment.",
    "{N}, who owns {pkg}, did not answer.", "the owner of {pkg} is {N}, {P}", "{pkg} {ver} was pushed by {N}.", "Analysis\n{N} decoded the strings.", "Background\nNone. {N} supplied a sample.", "Timeline\n20{two}-01-{two}: {N} writes to {role}\n20{two}-02-{two}: fix", "Finder: {N}", "Title: Dr. {N}\nOrganisation: {org}", "{N}: thanks, merged.", "Only {N} may publish {pkg}.",
    # nothing personal in these
    "Lines {three} to {four} were removed.", "bytes {three}-{four} of the block", "Range {four}-{four} is reserved.", "see ticket 20{two}-{three}", "Ticket 20{two}-0{one}-{three} stays open.", "case {four}-{four}", "Invoice 20{two}-{four} is due.", "The order number is {three}-{four}.", "Build 20{two}0{one}{two}.{four} passed.", "nightly 20{two}0{one}{two}-{four}", "snapshot 20{two}0{one}{two}{four}", "sha256:{hex}", "commit {hex}",
    "Digest {hex} differs.", "the file {hex}.tgz", "CVE-20{two}-{four}", "CVE-20{two}-{five} and CVE-20{two}-{four} are related.", "GHSA-{four}-{lower}-{lower}", "RUSTSEC-20{two}-{four}", "PYSEC-20{two}-{three}", "MAL-20{two}-{five}", "ISBN 978-3-16-{six}-0", "20{two}-0{one}-{two}T0{one}:{two}:{two}Z", "20{two}-0{one}-{two} 1{one}:{two}:{two}.{three}", "between 20{two}-0{one}-{two} and 20{two}-0{one}-{two}", "{two}/0{one}/20{two}",
    "epoch {ten}", "took {four} ms for {five} rows", "{five} downloads in {two} days", "{six} installs so far", "about {six} people use {pkg}", "listening on 10.{two}.{three}.{two}:{four}", "blocked 198.51.100.{two} and 203.0.113.{two}", "dns answers from 8.8.{one}.{one}:53", "requires node >= {ver}", "bump {pkg} from {ver} to {ver}", "{pkg}@{ver} is fine", "install {pkg}@{ver} instead", "npm i {pkg}@^{ver}",
    "port {four} or {five}", "Error {five}: no route", "exit code {three}", "id: {five}", "id={ten}", "uuid {uuid}", "serial {caps}-{four}-{four}", "model {caps}{three}", "part no. {caps}-{five}", "flight {caps} {four}", "room {three}", "account number of the parcel service: none", "salt$ {hex}", "h:{hex}", "const MAX = {six};", "0x{lower}{four}", "score {three}.{four}", "{five} + {five} = {six}", "Fig. {one}.{two}", "page {three} of {four}",
    "the Release Notes explain it", "Open Settings and choose Privacy Policy.", "Read the Contributor Guide first.", "Command Line Tools are needed.", "The Quick Start Guide is out of date.", "The {Word} Browser ships with it.", "{Word} Cloud and {Word} Mobile are not affected.", "a bug in {Word} Server", "The {Word} API returns text.", "Windows Server and Android Studio", "Visual Basic is old.", "The Great Wall is long.", "Black Friday sale", "New Year greetings",
    "North America and South Africa", "United Nations report", "the Main Street Theme is pretty", "Take the Second Street exit.", "A Place for Everything", "Way Too Many Options", "Drive and Park are verbs.", "Road Map", "the Wall Street Journal", "Square One", "{org} answered within a day.", "{org} and {org} signed the contract.", "Thanks to everyone at {org}.", "reported through {org}", "Sponsored by {org}", "Written for {org}", "Write to {role}.", "Complaints: {role}",
    "mail {role} and wait", "answers come from {role}", "{role} is a shared inbox", "user {role}", "?to={encoded_role}&x={two}", "ref={pkg}%40{ver}", "/{plain}@{ver}/dist", "look at line {three} at the end", "meet at noon dot com style", "He is at work. Net result: none.", "The word at is short and dot is shorter.", "@{login} opened this", "by {login}", "user {login} uploaded {pkg}", "maintainers: {login}, {login}", "https://{plain}.example/{Word}/{Word}-Guide.html", "git checkout {hex}",
    "Denial of service", "Remote code execution in {pkg}", "Path checks are missing in {pkg} before {ver}", "Cross-site Scripting", "Prototype chain abuse", "Arbitrary File Write", "Use After Free in the Parser", "Uncontrolled Resource Consumption", "Improper Input Validation", "SQL Injection", "Not Affected", "Summary\nDetails\nImpact\nPatches\nWorkarounds", "Bad Request", "Internal Server Error", "TODO", "README", "THE SOFTWARE IS PROVIDED AS IS", "WITHOUT WARRANTY OF ANY KIND",
    "Apache License", "MIT License", "BSD-3-Clause", "Der Server ist langsam. Das Paket wurde entfernt.", "Die Prüfsumme stimmt nicht.", "Le paquet est cassé. Les Journaux sont vides.", "El paquete no funciona. Los Archivos faltan.", "这个软件包有问题。", "バージョンを確認してください。", "Пакет удалён из реестра.", "It Was New. My Package Is Old. An Error In The Log", "Please Read The Manual. No Support", "Hello World", "Monday Morning", "March {two}", "5 April 20{two}", "{Word} is a town.", "We use {Word} and {Word} here.", "The {Word} module loads {Word}.",
    "Yes. No. Maybe.", "See Also", "Known Problems", "What Changed", "Who is affected? Users of {pkg}.", "Versions {ver} and {ver} only.", "- {plain}\n- {plain}\n- {plain}", "{plain} {plain} {plain} {plain}", "nothing to see here", "the cat sat on the mat while {four} mice watched", "Rotate your keys, then run npm cache clean.", "All copies before {ver} phone home to https://{plain}.invalid/{hex}", "the number of users is {five}", "call the function twice", "mail merge works", "the id field holds {hex}", "tax of {two} percent", "passport.js {ver}", "address 0x{lower}", "The phone app {Word} {ver}",
)
NAME_FIELDS = ("{N}", "{N}", "{N}", "{org}", "{login}", "{pkg}", "Robot")
CONTACTS = ("{E}", "mailto:{E}", "{P}", "{P}", "tel:{P}", "https://{plain}.example/{plain}", "{role}", "mailto:{role}", "{clone}", "@{login}", "https://{plain}.example/?u={U}", "{N} <{E}>")
LABELS = {"N": "name", "E": "email", "U": "email", "P": "phone", "I": "id_number", "A": "address"}
#: Share of samples by form: a field for names, a field for contacts, a single sentence; the rest are paragraphs.
SHARES = (0.1, 0.1, 0.4)


def fill(g: Generator, template: str) -> tuple[str, set[tuple[str, int, int]]]:
    """A text of the template, and its labelled spans."""
    text, gold = "", set()
    r = g.r
    number = lambda n: str(r.randint(10 ** (n - 1), 10**n - 1))
    hexes = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    plain = {
        "pkg": g.package, "ver": g.version, "org": lambda: r.choice(_ORGS), "plain": lambda: r.choice(_PLAIN), "Word": g.word, "role": g.role_email, "encoded_role": lambda: g.role_email().replace("@", "%40"), "clone": g.clone_login, "town": g.town,
        "one": lambda: str(r.randint(1, 9)), "two": lambda: f"{r.randint(10, 28):02d}", "three": lambda: number(3), "four": lambda: number(4), "five": lambda: number(5), "six": lambda: number(6), "ten": lambda: number(10), "hex": lambda: hexes(r.choice((7, 12, 32, 40, 64))),
        "lower": lambda: "".join(r.choice("abcdefghjkmnpqr23456789") for _ in range(4)), "caps": lambda: "".join(r.choice("ABCDEFGHKLMNPRSTUXYZ") for _ in range(r.randint(2, 3))), "uuid": lambda: "-".join(hexes(n) for n in (8, 4, 4, 4, 12)), "login": lambda: r.choice(_PLAIN) + g.digits(r.randint(0, 4)),
    }
    draw = {"N": g.name, "E": g.email, "U": g.encoded_email, "P": g.phone, "I": g.identity, "A": g.address}
    for part in re.split(r"(\{\w+\})", template):
        key = part[1:-1] if part.startswith("{") else None
        if key in LABELS:
            item = draw[key]()
            gold.add((LABELS[key], len(text), len(text) + len(item)))
            text += item
        else:
            text += plain[key]() if key in plain else part
    return text, gold


def samples(count: int, seed: int = 20260301, texts: tuple[str, ...] = TEXTS) -> list[tuple[str, int, set[tuple[str, int, int]]]]:
    """(text, field, labelled spans), by ``SHARES``; the number of a field is that of ``pii_model.Page``."""
    g = Generator(seed)
    out = []
    for _ in range(count):
        form = g.r.random()
        if form < SHARES[0]:
            text, gold = fill(g, g.r.choice(NAME_FIELDS))
            out.append((text, g.r.choice((1, 1, 1, 0)), gold))
        elif form < sum(SHARES[:2]):
            text, gold = fill(g, g.r.choice(CONTACTS))
            out.append((text, g.r.choice((2, 2, 2, 0)), gold))
        elif form < sum(SHARES):
            text, gold = fill(g, g.r.choice(texts))
            out.append((text, 0, gold))
        else:
            text, gold = "", set()
            for _ in range(g.r.randint(2, 4)):
                more, spans = fill(g, g.r.choice(texts))
                gold |= {(k, a + len(text), b + len(text)) for k, a, b in spans}
                text += more + ("" if more[-1:] in ".?!:" else g.r.choice((".", "", ""))) + g.r.choice((" ", " ", "\n", "\n\n"))
            out.append((text, 0, gold))
    return out
