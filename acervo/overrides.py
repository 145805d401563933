"""Values that belong to single documents, kept apart from the rules. All of them are arguments of the operators that use them.

Fixed values, as plain text: they must equal what these documents hold.
"""

#: Labels of the drawings of one circular, without marks and accents.
DRAWING_LABELS = (
    "edificio", "piscina", "piscinas", "chimenea", "chimeneas", "pergola", "pergolas", "ascensores", "baranda", "barandas", "paramentos", "paramentos perimetrales", "perimetrales", "escalera",
    "jardineras", "ornamentales", "quincho", "quinchos", "otros", "salida caja de", "salida caja de escalera", "terraza", "terraza terraza", "vegetacion", "vegetacion jardineras",
    "maximo 25 de la superficie de la azotea", "altura maxima de edificacion permitida por el ipt", "piscinas vegetacion jardineras elementos ornamentales",
    "salas de maquinas cajas de escalera chimeneas", "con un maximo de 99", "pergolas quinchos otros",
)

#: Beginnings of cells of the tables of one circular that may be left over in its body.
TABLE_CELLS = (
    "1. Loteos (Art. 2.2.4.",
    "2. Proyectos que se acojan al régimen de copropiedad",
    "3. División afecta a declaratoria de utilidad",
    "1. Obras de urbanización voluntarias en el espacio",
    "2. Obras de urbanización voluntarias al interior",
    "Cualquiera de las obras de urbanización contempladas en el artículo 134",
    "Específica ",
    "Se aborda esta materia en la presente circular",
    "Expiró el plazo que se informaba",
    "1. En el punto 2",
    "2. En el punto 2",
    "1. Se reemplaza el punto",
    "2. Se reemplaza el punto",
    "3. En el punto 4",
    "2. En el punto 3",
    "Se deja sin efecto por completo la Circular",
)

#: Phrases of one circular behind which a number set apart by a blank is the call of a footnote.
NOTE_CALLS = (
    ("N° 97 /2007", 1),
    ("imágenes", 2),
    ("al interior de un predio", 3),
    ("área verde", 3),
    ("exigencias y efectos aplicables", 5),
    ("superficie de este", 7),
    ("permiso de urbanización de la DOM)", 9),
    ("urbanización", 10),
    ("pendientes)", 12),
    ("2.2.1. de la OGUC", 13),
    ("subdivisión del predio", 15),
    ("permiso de la DOM", 16),
    ("3.1.8. de la OGUC", 18),
    ("público", 20),
    ("anteproyectos", 22),
    ("a través de servidumbres", 24),
    ("presentados a la DOM", 26),
    ("2.2.9. de la OGUC", 28),
    ("2.2.9 de la OGUC", 28),
    ("de ese inciso", 30),
    ("artículo 1.1.2.", 31),
)

#: Words of titles that follow a lone numeral, sentences that follow a call at the start of a line, and numerals that open no paragraph.
TITLE_WORDS = ("MARCO", "URBANIZACIÓN", "HIPÓTESIS", "OBRAS", "PERMISOS", "RECEPCIÓN", "CIRCULARES", "OTRAS")
CALL_SENTENCES = ("para todas", "En esos casos", "y cumplan")
NO_PARAGRAPH = ("En el punto 2,", "En el punto 5,", "En el punto 6,", "En el punto 15,", "Se reemplaza el punto")

#: Circulars whose mention names a table.
NAMED_TABLES = ("DDU 339", "DDU 322", "DDU 168")
