"""The language of a text, by profiles of its character trigrams.

A profile is made of the first article of the Universal Declaration of Human
Rights and of frequent short words.  It says how likely each hashed trigram is
in a language; a text belongs to the language under which its trigrams are the
likeliest, whatever its length.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

#: The article in each language, and after the bar frequent words.
SAMPLES = {
    "en": "All human beings are born free and equal in dignity and rights. They are endowed with reason and conscience and should act towards one another in a spirit of brotherhood. | the of and to in is was for that with it as by from at on than this an or be are were which their his her has had not but they any such some each only after before into there about would could who when what will been have more",
    "de": "Alle Menschen sind frei und gleich an Würde und Rechten geboren. Sie sind mit Vernunft und Gewissen begabt und sollen einander im Geist der Brüderlichkeit begegnen. | der die das und ist wird von zu mit den dem ein eine einer eines im nicht auf bis sich nach für bei soll sollte vorher wer man muss hat dass jede jeder kam laut hört vor neben zwischen noch als aus auch werden wurde über durch",
    "fr": "Tous les êtres humains naissent libres et égaux en dignité et en droits. Ils sont doués de raison et de conscience et doivent agir les uns envers les autres dans un esprit de fraternité. | le la les des du et est une dans qui pour au aux avec sur cette ce près il elle ils se son sa ses avant après selon dès que pas plus par leur été ont fait comme mais nous vous où",
    "es": "Todos los seres humanos nacen libres e iguales en dignidad y derechos y, dotados como están de razón y conciencia, deben comportarse fraternalmente los unos con los otros. | el la los las del y una con por para su al cerca hay más como entre cada según antes después cuando desde mucha gente hasta que en no se lo pero sus este esta fue también muy donde sobre",
    "it": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza. | il lo la gli le del della dei delle e un una che non per con su da al alla nel nella è sono come più anche questo questa suo sua ogni dopo prima quando dove molto era stato essere dalla",
    "pt": "Todos os seres humanos nascem livres e iguais em dignidade e em direitos. Dotados de razão e de consciência, devem agir uns para com os outros em espírito de fraternidade. | o a os as do da dos das e um uma que não para com por em no na nos nas ao à é são como mais também este esta seu sua cada depois antes quando onde muito foi ser pela pelo até há",
    "nl": "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten, en behoren zich jegens elkander in een geest van broederschap te gedragen. | de het een en van in is dat op te zijn met voor niet aan er om ook als dan maar bij nog uit door over naar heeft werd wordt deze die elke voordat wanneer waar veel was kan meer tot hun",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa. | i w na z do nie się że jest to od po przez dla jak ale który która które są był była było być już tylko po przed kiedy gdzie bardzo każdy oraz jego jej ich przy lub może",
    "sv": "Alla människor är födda fria och lika i värde och rättigheter. De är utrustade med förnuft och samvete och bör handla gentemot varandra i en anda av broderskap. | och i att det som en på är av för med den till inte om ett men har de var från vid när så kan efter före under mycket varje också eller hans hennes",
    "da": "Alle mennesker er født frie og lige i værdighed og rettigheder. De er udstyret med fornuft og samvittighed, og de bør handle mod hverandre i en broderskabets ånd. | og i at det som en på er af for med den til ikke om et men har de var fra ved når så kan efter før under meget hver også eller hans hendes blev",
    "cs": "Všichni lidé rodí se svobodní a sobě rovní co do důstojnosti a práv. Jsou nadáni rozumem a svědomím a mají spolu jednat v duchu bratrství. | a v na se je že to s z do o i pro jako ale by jsem od po jeho který která které jsou byl byla bylo být také jen nebo při před když kde velmi každý",
    "ro": "Toate ființele umane se nasc libere și egale în demnitate și în drepturi. Ele sunt înzestrate cu rațiune și conștiință și trebuie să se comporte unele față de altele în spiritul fraternității. | de la și în a cu pe nu că este un o din pentru care sunt mai ca se au fost după înainte când unde foarte fiecare sau dar lui ei",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler. | ve bir bu da de için ile çok daha gibi kadar ne o en ama her sonra önce olan olarak değil var yok ki mi ya veya nerede zaman",
}
#: Hash buckets of trigrams, and the weight that a trigram unseen in a sample has.
BUCKETS, UNSEEN = 1 << 14, 0.25


_NO_LETTERS = re.compile(r"[\W\d_]+")


def _trigrams(text: str) -> np.ndarray:
    points = np.frombuffer(f"  {' '.join(text.lower().split())} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(points) < 3:
        return np.zeros(0, np.int64)
    h = (points[:-2] * np.uint64(0x9E3779B1) + points[1:-1]) * np.uint64(0x85EBCA77) + points[2:]
    return ((h * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(50)).astype(np.int64)


@lru_cache(maxsize=1)
def _profiles() -> tuple[list[str], np.ndarray]:
    rows = []
    for sample in SAMPLES.values():
        counts = np.bincount(_trigrams(sample.replace("|", " ")), minlength=BUCKETS) + UNSEEN
        rows.append(np.log(counts / counts.sum()))
    return list(SAMPLES), np.array(rows)


def by_trigrams(text: str) -> tuple[str, float]:
    """(language, how much likelier a trigram is under it than under the next one); ('', 0) for a text without letters."""
    grams = _trigrams(_NO_LETTERS.sub(" ", text))
    if len(grams) < 12:
        return "", 0.0
    names, logs = _profiles()
    likely = logs[:, grams].mean(1)
    first, second = np.argsort(likely)[::-1][:2]
    return names[first], float(likely[first] - likely[second])
