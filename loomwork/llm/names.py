"""Given names by gender and script, forms of address, and composed surnames."""

from __future__ import annotations

import functools
import hashlib
import hmac
import re

_GIVEN = {
    ("latin", "f"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Sandra Ashley Emily Kimberly Donna Michelle Carol Amanda Melissa Deborah Stephanie Rebecca Laura Cynthia Kathleen Amy Angela Shirley Emma Olivia Sophia Isabella Charlotte Amelia Hannah Julia Katharina Ursula Ingrid Heike Sabine Petra Monika Claudia Anja Greta Camille Chloé Manon Léa Élodie Juliette Amélie Céline Aurélie Sylvie Brigitte Nathalie Anna Maria Sara Elena Marta Helena Sophie Julie Louise Claire Marie Isabelle Ana Lisa Lena Johanna Christina Teresa Priya Ananya Aisha Fatima Zainab Deepika Kavita Sunita Lakshmi Meera Neha Pooja Shreya Anjali Divya Xiu Yuki Sakura Haruka Keiko Olga Svetlana Natalia Tatiana Irina Ekaterina Anastasia Yulia Oksana Katarzyna Agnieszka Małgorzata Zofia Giulia Chiara Francesca Alessandra Federica Ingeborg Astrid Sigrid Freja Linnea Femke Sanne Anouk Ayşe Elif Zeynep Emine Leila Layla Nadia Yasmin Amina Khadija Ngozi Chioma Wanjiru Akua Thandiwe Ji-woo Min-ji Carmen Lucía María Sofía Valentina Camila Daniela Gabriela Alejandra Beatriz Pilar Mercedes".split(),
    ("latin", "m"): "James Robert John Michael David William Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Steven Andrew Kenneth Kevin Brian George Edward Ronald Timothy Jason Jeffrey Ryan Jacob Gary Nicholas Eric Jonathan Stephen Larry Justin Scott Brandon Benjamin Samuel Gregory Alexander Oliver Lukas Maximilian Felix Jürgen Wolfgang Klaus Dieter Günther Stefan Matthias Jens Uwe Pierre Jacques Antoine François Émile Olivier Laurent Philippe Mathieu Sébastien Martin Peter Paul Hans Anton Simon Adam Lucas Louis Hugo Jules Henri Jean Luis Juan Manuel Antonio Francisco Jorge Alberto Ricardo Roberto Eduardo Wei Jian Hiroshi Takashi Kenji Satoshi Haruto Mohammed Muhammad Mohamed Ahmed Ahmad Ali Omar Hassan Hussein Ibrahim Yusuf Mustafa Mehmet Emre Murat Khalid Tariq Rajesh Suresh Ramesh Amit Arjun Rahul Sanjay Vijay Vikram Ravi Anil Sunil Sergei Dmitri Alexei Andrei Vladimir Nikolai Mikhail Ivan Igor Oleg Pavel Yuri Boris Piotr Paweł Krzysztof Andrzej Tomasz Jakub Giovanni Giuseppe Marco Luca Matteo Alessandro Francesco Lorenzo Paolo Stefano Lars Sven Erik Nils Bjørn Magnus Henrik Olaf Pieter Willem Joost Kwame Kofi Emeka Tunde Sipho Thabo Jae-hyun Sung-min João Pedro Luís Tiago Gonçalo Paulo Thiago Carlos José Miguel Alejandro Javier Diego Pablo Sergio Fernando Andrés Rafael Ignacio".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Екатерина Юлия Дарья Ксения Полина Виктория Людмила Галина".split(),
    ("cyrillic", "m"): "Александр Сергей Дмитрий Андрей Алексей Иван Михаил Николай Владимир Павел Евгений Олег Виктор Юрий Игорь Борис".split(),
    ("greek", "f"): "Μαρία Ελένη Αικατερίνη Βασιλική Σοφία Αγγελική Γεωργία Δήμητρα Κωνσταντίνα Παναγιώτα".split(),
    ("greek", "m"): "Γεώργιος Δημήτριος Κωνσταντίνος Ιωάννης Νικόλαος Χρήστος Παναγιώτης Βασίλειος Αθανάσιος Μιχαήλ".split(),
}
_TITLES = {"mr": "m", "mister": "m", "mrs": "f", "ms": "f", "miss": "f", "dr": "", "prof": "", "professor": "", "herr": "m", "frau": "f", "monsieur": "m", "madame": "f", "mme": "f", "mlle": "f", "señor": "m", "señora": "f", "señorita": "f", "don": "m", "doña": "f", "г-н": "m", "г-жа": "f", "господин": "m", "госпожа": "f", "κύριος": "m", "κυρία": "f"}
_RUN = re.compile(r"[^\W\d_]+")
_GENDER = {n.casefold(): (s, g) for (s, g), own in _GIVEN.items() for n in own}
_SYLLABLES = {
    "latin": ("ba be bi bo bra bre ca co cra da de di do dra fa fe fi fo fra ga ge go gra ha he hi ho ja jo ka ke ki ko kra la le li lo ma me mi mo na ne ni no pa pe pi po pra ra re ri ro sa se si so sta ta te ti to tra va ve vi vo wa we wi".split(), "ber dal den dorf ford gard ham holm ing land ler lin man mer ner nik rell ren ron ser sen son stad ston ter ton vard vell win worth".split()),
    "cyrillic": ("ба бе бо бра ва ве ви во га го гра да де ди до жа за зе ка ке ки ко кра ла ле ли ло ма ме ми мо на не ни но па пе по ра ре ри ро са се си со ста та те ти то".split(), "бов велов дов рин лов ленков мов нев нин ров рских сев син тов шин".split()),
    "greek": ("βα γε γα δα δε δι θα θε κα κο κα λα λε λι λο μα με μι μο να νε νι πα πε πι πο ρα ρε ρι σα σε στα τα τε τι".split(), "δάκης λάκης νάκης ράκης σόπουλος νόπουλος λίδης ρίδης τίδης".split()),
}


#: How the first run of letters of a name or title may be written: a text without any of these has none.
FIRSTS = frozenset(form for n in [*_GENDER, *_TITLES] for form in (_RUN.match(n)[0].capitalize(), _RUN.match(n)[0].upper()))


def script(word: str) -> str:
    c = word[:1]
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿" else "latin"


def capital(word: str) -> bool:
    """A capital first, then small letters, or capitals throughout; two letters at least."""
    return len(word) > 1 and word[0].isupper() and (word[1:].islower() or word.isupper() or any(x in word for x in "'’-") or word[1:].lower() != word[1:])


def gender_of(word: str) -> str:
    return _GENDER.get(word.casefold(), ("", ""))[1]


def is_title(word: str) -> bool:
    return word.casefold() in _TITLES


def title_gender(word: str) -> str:
    return _TITLES[word.casefold()]


def surname_gender(word: str, gender: str) -> str:
    """Gender of a surname where its form shows it: in Cyrillic script by its ending."""
    if script(word) != "cyrillic":
        return ""
    w = word.casefold()
    return "f" if w.endswith(("ова", "ева", "ина", "ая")) else "m" if w.endswith(("ов", "ев", "ин", "ий")) else gender


@functools.lru_cache(maxsize=64)
def _order(key: bytes, script_: str, gender: str) -> dict[str, str]:
    """A cycle through the names in keyed order: each name's surrogate is the next, never itself."""
    own = [x.casefold() for x in _GIVEN[script_, gender]]
    own.sort(key=lambda x: hmac.new(key, f"given\0{x}".encode(), hashlib.sha256).digest())
    return {x: own[(i + 1) % len(own)] for i, x in enumerate(own)}


def permuted(key: bytes, script_: str, gender: str, word: str) -> str:
    return _order(key, script_, gender)[word]


def surname(d, script_: str, gender: str, attempt: int) -> str:
    middle, ends = _SYLLABLES[script_]
    word = "".join(middle[d.below(len(middle))] for _ in range(2 + attempt // 4)) + ends[d.below(len(ends))]
    if script_ == "cyrillic" and gender == "f" and word.endswith(("ов", "ев", "ин")):
        word += "а"
    return word
