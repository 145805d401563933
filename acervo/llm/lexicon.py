"""Word lists of Spanish personal names. Public, general knowledge; values are fixed and in natural order."""

# Common given names, without accents.
GIVEN = tuple(
    """adriana agustin aida alberto alejandra alejandro alfonso alfredo alicia alonso alvaro amanda amelia ana andrea andres angela
    angelica anibal antonia antonio ariel armando arturo augusto aurora barbara beatriz belen benjamin bernarda bernardo blanca boris
    bruno camila camilo carla carlos carmen carolina catalina cecilia cesar clara claudia claudio constanza cristian cristina cristobal
    daniel daniela david diana diego dolores edgardo edith eduardo elena eliana elias elisa elsa emilia emilio enrique erica ernesto
    esteban estela eugenia eugenio eva fabian fabiola federico felipe fernanda fernando francisca francisco gabriel gabriela german
    gerardo gilda gloria gonzalo graciela gregorio guillermo gustavo hector hernan hilda hugo ignacia ignacio ines irene iris isabel
    ivan jacinta jaime javier javiera jeronimo joaquin jorge jose josefa juan juana julia julian julio karina laura leonardo leonor
    leticia lidia lorena lorenzo lucas lucia luis luisa magdalena manuel manuela marcela marcelo marco margarita maria mariana mario
    marta martin mateo matias mauricio maximiliano mercedes miguel miriam monica natalia nelson nicolas nora norma olga oscar osvaldo
    pablo paola patricia patricio paula paulina pedro pilar rafael ramon raquel raul rebeca renato ricardo roberto rodolfo rodrigo
    rolando rosa rosario ruben sandra santiago sara sebastian sergio silvia simon sofia sonia susana teresa tomas valentina valeria
    vanessa veronica vicente victor victoria violeta virginia viviana ximena yolanda""".split()
)

# The spellings with accents of the given names above that have them.
ACCENTED = tuple(
    """agustín álvaro andrés ángela angélica aníbal bárbara belén benjamín césar cristián cristóbal elías fabián germán héctor hernán inés
    iván jerónimo joaquín josé julián lucía martín matías míriam maría mónica nicolás óscar raúl ramón rubén sebastián simón sofía tomás
    verónica víctor""".split()
)

# Nicknames with the given names they stand for.
NICKNAMES = {
    "bea": ("beatriz",), "beto": ("alberto", "roberto"), "caco": ("carlos",), "cata": ("catalina",), "chabela": ("isabel",), "charo": ("rosario",),
    "chela": ("graciela",), "chelo": ("marcelo",), "chica": ("francisca",), "coca": ("maria",), "cote": ("maria", "jose"), "cristi": ("cristian", "cristina"),
    "dani": ("daniel", "daniela"), "fefi": ("josefa",), "fran": ("francisca", "francisco"), "gabi": ("gabriela", "gabriel"), "gaby": ("gabriela",), "gonza": ("gonzalo",),
    "guille": ("guillermo",), "isa": ("isabel",), "kike": ("enrique",), "lala": ("eduarda",), "lalo": ("eduardo",), "lola": ("dolores",), "lucho": ("luis",),
    "lupe": ("guadalupe",), "male": ("magdalena",), "mane": ("manuel",), "manolo": ("manuel",), "maruja": ("maria",), "mati": ("matias",), "memo": ("guillermo",),
    "meche": ("mercedes",), "moni": ("monica",), "nacha": ("ignacia",), "nacho": ("ignacio",), "nando": ("fernando", "hernan"), "nico": ("nicolas",), "pancha": ("francisca",),
    "pancho": ("francisco",), "pato": ("patricio",), "paty": ("patricia",), "pati": ("patricia",), "paco": ("francisco",), "pepa": ("josefa",), "pepe": ("jose",), "pipe": ("felipe",),
    "quique": ("enrique",), "quino": ("joaquin",), "rafa": ("rafael",), "rena": ("renata",), "rodri": ("rodrigo",), "rosita": ("rosa",), "seba": ("sebastian",), "sofi": ("sofia",),
    "tere": ("teresa",), "tito": ("roberto", "alberto"), "toña": ("antonia",), "tona": ("antonia",), "toño": ("antonio",), "tono": ("antonio",), "tomy": ("tomas",), "vero": ("veronica",),
    "xime": ("ximena",), "yoli": ("yolanda",),
}

# Accents folded one character to one.
FOLD = str.maketrans("áàäâãéèëêíìïîóòöôõúùüûñçÁÀÄÂÃÉÈËÊÍÌÏÎÓÒÖÔÕÚÙÜÛÑÇ", "aaaaaeeeeiiiiooooouuuuncAAAAAEEEEIIIIOOOOOUUUUNC")
