"""Given names and their short forms, for finding and linking names of people."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

# Common given names of several languages, each with its usual short forms. A sample of them: names
# outside the list are found by their shape and context, and linked by the similarity of their letters.
SHORT_FORMS = {
    "Adam": "", "Adele": "", "Agnes": "Aggie", "Albert": "Al Bert Bertie", "Alejandro": "Jandro", "Alexander": "Alex Sasha Sandy Xander", "Alice": "", "Anaïs": "", "Anastasia": "Nastya Stacy", "Andrew": "Andy Drew", "Anna": "Annie", "Anthony": "Tony",
    "Arturo": "Turi", "Astrid": "Asta", "Augustin": "Gus Augie", "Barnaby": "Barney", "Beatriz": "Bea Triz", "Benjamin": "Ben Benji Benny", "Björn": "", "Carlos": "", "Catherine": "Cathy", "Cecilia": "Cece Cissy", "Charles": "Charlie Chuck", "Christopher": "Chris Kit Topher",
    "Claire": "", "Concepción": "Concha Conchita", "Cordelia": "Delia Cory", "Daniel": "Dan Danny", "David": "Dave", "Desmond": "Des Desi", "Dmitri": "Dima Mitya", "Dolores": "Lola Loli", "Dorothea": "Thea Dora Dot", "Edward": "Ed Eddie Ned Ted Teddy", "Ekaterina": "Katya", "Eleanor": "Ellie Nell Nora",
    "Elizabeth": "Beth Betty Liz Lizzie Eliza", "Emma": "", "Emmanuel": "Manny Manu", "Ferdinand": "Ferdi Nando", "Francisco": "Paco Pancho", "François": "", "Frederika": "Rika Freddie", "George": "Georgie", "Giuseppe": "Beppe Pepe Peppe", "Gregory": "Greg", "Guillaume": "", "Gwendolyn": "Gwen",
    "Hannah": "", "Harold": "Hal Harry", "Helen": "", "Henrietta": "Etta Hettie", "Henry": "Hank", "Hiroko": "", "Hugo": "", "Ignacio": "Nacho", "Ingrid": "Inga", "Isabella": "Bella Izzy", "Jacqueline": "Jackie", "James": "Jim Jimmy Jamie", "Johannes": "Hannes Jo", "John": "Johnny Jack", "Jonathan": "Jon Jonny",
    "José": "Pepe", "Joseph": "Joe Joey", "Jürgen": "", "Karl": "", "Katherine": "Kate Kathy Kitty Katie", "Kenji": "Ken", "Konstantin": "Kostya", "Lawrence": "Larry Laurie", "Leila": "", "Leonard": "Len Lenny Leo", "Lorenzo": "Renzo", "Louis": "Lou", "Łukasz": "", "Luis": "", "Margaret": "Maggie Meg Peggy Greta",
    "Marguerite": "Margot", "Maria": "Mia", "Matilda": "Tilda Tilly Mattie", "Maximilian": "Max", "Michael": "Mick Mike Mickey", "Mohammed": "Mo", "Nathaniel": "Nat Nate", "Nicholas": "Nick", "Nikolaus": "Klaus Niko", "Olivia": "Liv Livvy", "Omar": "", "Ottilie": "Otti Tilly", "Patricia": "Pat Patty Trish",
    "Paul": "", "Penelope": "Penny", "Peter": "Pete", "Philippa": "Pippa Pip", "Prudence": "Prue", "Quentin": "", "Rebecca": "Becky Becca", "Reginald": "Reg Reggie", "Renée": "", "Richard": "Dick Rich Rick", "Robert": "Bob Bobby Rob Robbie", "Rosalind": "Ros Roz", "Samuel": "Sam Sammy", "Seraphine": "Fina Sera", "Søren": "",
    "Sophie": "", "Stanislav": "Stas", "Susanne": "Susi Sanne", "Theodore": "Ted Theo", "Thomas": "Tom Tommy", "Timothy": "Tim Timmy", "Tobias": "Toby Tobi", "Ulrike": "Uli Rike", "Ursula": "Uschi Ulla", "Valentina": "Valya Tina Val", "Victoria": "Tori Vicky", "Vincent": "Vince Vinny", "Vladimir": "Vlad Volodya Vova",
    "Wilhelmina": "Mina Minnie", "William": "Bill Billy Will", "Winifred": "Winnie Freddie", "Wolfgang": "Wolf Wolfi", "Xavier": "Xavi", "Yolanda": "Yoli", "Yusuf": "", "Zacharias": "Zach Zack", "Zoë": "",
    "Aisha": "", "Alberto": "Berto", "Amara": "", "Ananya": "", "Antonio": "Toni", "Bernard": "Bernie", "Caroline": "Caro Carrie", "Chiara": "", "Chidi": "", "Deborah": "Deb Debbie", "Diego": "", "Dominik": "Nik", "Eduardo": "Edu", "Elena": "Lena", "Emily": "Em", "Enrique": "Quique", "Esther": "Essie",
    "Fatima": "", "Frederick": "Fred Freddy", "Gabriela": "Gabi", "Gertrude": "Gert Trudy", "Giovanni": "Gianni Vanni", "Guadalupe": "Lupe", "Gustav": "", "Heinrich": "Heinz", "Hiroshi": "", "Ibrahim": "", "Jennifer": "Jen Jenny", "Jessica": "Jess Jessie", "Joshua": "Josh", "Juan": "", "Kenneth": "Kenny",
    "Kwame": "", "Laura": "", "Leopold": "Poldi", "Lucía": "Lucha", "Magdalena": "Magda Lena", "Manuel": "Manolo", "Martin": "", "Matthew": "Matt", "Mikhail": "Misha", "Natalia": "Natasha", "Ngozi": "", "Nikita": "", "Oluwaseun": "Seun", "Olga": "Olya", "Oscar": "", "Pablo": "", "Priya": "", "Rafael": "Rafa",
    "Raymond": "Ray", "Roberto": "", "Ronald": "Ron Ronnie", "Rosario": "Charo", "Rudolf": "Rudi", "Salvador": "Chava", "Sarah": "Sally", "Sebastian": "Seb Basti", "Sergei": "Seryozha", "Stephen": "Steve Stevie", "Tatiana": "Tanya", "Thandiwe": "Thandi", "Ulrich": "Uli", "Veronica": "Ronnie", "Walter": "Walt", "Yuki": "", "Zoltan": "Zoli",
}

# Letters with their plain spelling where it isn't a letter with a mark.
PLAIN = str.maketrans({"ß": "ss", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "đ": "d", "Đ": "D", "ı": "i", "þ": "th", "ð": "d"})
UMLAUT = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ø": "oe", "å": "aa"})


@lru_cache(maxsize=1 << 16)
def plain(word: str) -> str:
    """A word in lower case without marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", word.translate(PLAIN)) if not unicodedata.combining(c)).lower()


@lru_cache(maxsize=1)
def full_names() -> frozenset[str]:
    return frozenset(plain(x) for n in SHORT_FORMS for x in (n, n.lower().translate(UMLAUT)))


@lru_cache(maxsize=1)
def short_names() -> frozenset[str]:
    return frozenset(plain(s) for v in SHORT_FORMS.values() for s in v.split())


@lru_cache(maxsize=1)
def full_of() -> dict[str, frozenset[str]]:
    """Full names, plain, that a plain full or short name may stand for."""
    out: dict[str, set[str]] = {}
    for name, shorts in SHORT_FORMS.items():
        for x in (name, name.lower().translate(UMLAUT), *shorts.split()):
            out.setdefault(plain(x), set()).add(plain(name))
    return {k: frozenset(v) for k, v in out.items()}


def one_edit_keys(word: str) -> set[str]:
    """The word and all of it with one letter left out: two words one edit apart share a key."""
    return {word} | {word[:i] + word[i + 1 :] for i in range(len(word))}


@lru_cache(maxsize=1)
def near_keys() -> dict[str, frozenset[str]]:
    """Full names of four letters or more by their keys."""
    out: dict[str, set[str]] = {}
    for n in full_names():
        if len(n) >= 4:
            for k in one_edit_keys(n):
                out.setdefault(k, set()).add(n)
    return {k: frozenset(v) for k, v in out.items()}


def one_edit_apart(a: str, b: str) -> bool:
    """Equal, or one letter changed, left out, added, or two neighbours swapped."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :]
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


@lru_cache(maxsize=1 << 16)
def near_given(word: str) -> frozenset[str]:
    """Full names a plain word may stand for: as it is, as a short form, or with one slip of the pen."""
    if (known := full_of().get(word)) is not None:
        return known
    if len(word) < 4:
        return frozenset()
    near = near_keys()
    found = {n for k in one_edit_keys(word) for n in near.get(k, ()) if one_edit_apart(word, n)}
    return frozenset(f for n in found for f in full_of()[n])
