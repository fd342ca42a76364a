"""A second style for the segment model: letters, chat, bulletins and forms, with persons and patterns of their own.

Nothing here is used in training; ``pii_training`` shares neither its carriers nor its names with this module.
"""

import random

FIRST = "Gwendolyn Barnaby Ottoline Thaddeus Rosalind Ephraim Cordelia Lysander Mirabel Cuthbert Saoirse Padraig Ignacio Consuelo Ramón Lieselotte Friedhelm Kunigunde Guillaume Solène Anatole Xiomara Ljubica Zbigniew Oksana Haruto Nkechi Tarek Leila Bogdan".split()
LAST = "Abernathy Blenkinsop Carruthers Dalrymple Etherington Featherstone Goldsborough Hathaway Inglethorpe Jessop Kirkbride Lonsdale Massingham Nethercott Ormsby Pettigrew Quennell Ravenscroft Strickland Thistlewood Unsworth Villiers Witherspoon Yardley Zimmermann Bustamante Echeverría Villanueva Hohenstein Lindenthal Beaumont Charpentier Wiśniewska Adebayo".split()
STREETS = ["14 Marigold Lane, Brackenhurst LE4 7QP", "7 Cathedral Close, Wexcombe", "Flat 3, 88 Prince Albert Road, Dunmere", "2210 Cottonwood Drive, Apt 5, Redfield, KS 66523", "310 Sycamore Ave, Millersport, OH 43046", "Rosengasse 12, 80331 Altmünster", "Kapellenstraße 5a, 50667 Rheinau", "9 rue du Colombier, 69002 Valmy", "Calle del Almendro 21, 28005 Torrelaguna", "45A Harbour View, Portlowen TR11 3QY"]
MAILS = ["g.abernathy@larkhill.org", "otto_lonsdale77@postbox.co.uk", "ramon.villanueva@correo.es", "lysander (at) quillmail (dot) com", "mirabel.jessop [at] hostly [dot] net", "thaddeus at inkwell dot org", "SOLENE.B@COURRIER.FR", "f-hohenstein@praxis-rheinau.de"]
PHONES = ["(614) 555-0182", "+44 20 7946 0321", "0161 496 0752", "07700 900461", "+1 303 555 0147", "030 5550199", "+49 89 5550123", "06 12 55 01 98", "+34 612 555 019", "212-555-0199", "01632 960845"]
IDS = [
    ("her social security number is {}", ["514-28-7731", "602 44 1190"]), ("NHS number {}", ["485 777 3456", "943-476-5919"]), ("passport number {}", ["K4471902", "532187764", "C01X77H31"]),
    ("hospital number {}", ["B772913", "RX-440128", "2019/114402"]), ("insurance number {}", ["QQ 12 34 56 C", "Q123456789", "HMO-771204"]), ("taxpayer number {}", ["98-7654321", "912 555 310"]), ("patient ID {}", ["P00817264", "77-10442"]), ("record no. {}", ["4418207", "KL992031"]),
]
OTHERS = [
    "Batch 771 203 4410 of the vaccine was recalled on Monday.", "The protocol number is 118-402-7731.", "Please quote catalogue no. 55-20817 when you order.", "Specimen 402-77-1180 was stored at the depot in Wexcombe.", "See Carruthers et al., 2009, for the earlier series.",
    "The Dalrymple sign was absent and the Villiers score was 3.", "doi:10.5512/9982.41207", "Lunch is at twelve in the Great Hall of Redfield.", "Serial number 88120-4471 is printed below.", "Bring 2 pens, 3 rulers and 45 sheets of paper.", "Trial NCT04417720 closed early.", "Rheinau lies on the river, Valmy does not.",
    "CONTRAST CT OF THE ABDOMEN WAS REPEATED.", "In winter the road to Altmünster is shut.", "Lot no. 4471902 expired in 2021.", "Pressure 120/80, pulse 66, weight 71.5 kg.", "Figure 4 shows the left kidney.", "The Thistlewood classification has five grades.", "Grant 4471/2008 covered the fees.", "1 12 144 1728 20736 are powers.",
]


def texts(n: int, seed: int = 3):
    """(text, spots) pairs."""
    r = random.Random(seed)
    name = lambda: (r.choice([f"{r.choice(FIRST)} {r.choice(LAST)}"] * 4 + [f"{r.choice(FIRST)[0]}. {r.choice(LAST)}", f"{r.choice(LAST)}, {r.choice(FIRST)}", f"{r.choice(FIRST)} {r.choice('BDHKTW')}. {r.choice(LAST)}"]), "name")

    def ident():
        label, values = r.choice(IDS)
        a, b = label.split("{}")
        return [a, (r.choice(values), "id_number"), b]

    for _ in range(n):
        mail, phone, street = (r.choice(MAILS), "email"), (r.choice(PHONES), "phone"), (r.choice(STREETS), "address")
        some = [
            ["Hi team, can someone phone ", name(), " back on ", phone, " before noon?"], ["Forwarding this for ", name(), ", whose mail is ", mail, "."], ["Letter to the editor from ", name(), ", ", street, "."], ["The funeral notice named ", name(), " and ", name(), "."],
            ["Visitor log: ", name(), ", ", phone, ", arrived 9 am."], ["Note for file: ", *ident(), "."], ["Mrs ", name(), " told the desk that ", *ident(), "."], ["Neighbours say ", name(), " moved to ", street, " last year."], ["My new address is ", street, "."], ["You can text me on ", phone, "."],
            ["Kind regards,\n", name(), "\n", mail, "\n"], ["Customer: ", name(), "\nAddress: ", street, "\nPhone: ", phone, "\n"], ["We found the wallet of ", name(), "; ", *ident(), "."], ["Minutes taken by ", name(), "."], ["Dr. ", name(), " will cover the weekend."], ["Complaints go to ", mail, "."],
            ["Chat with ", name(), ": please use ", mail, " from now on."], ["Besuch von Frau ", name(), ", Telefon ", phone, "."], ["Madame ", name(), " habite ", street, "."], ["El paciente ", name(), " dejó el teléfono ", phone, "."],
        ]
        parts = []
        for _ in range(r.randint(1, 4)):
            parts += (r.choice(some) if r.random() < 0.6 else [r.choice(OTHERS)]) + [" "]
        out, spots, at = [], [], 0
        for p in parts:
            s, kind = (p, None) if isinstance(p, str) else p
            if kind:
                spots.append((at, at + len(s), kind))
            out.append(s)
            at += len(s)
        yield "".join(out), spots
