"""Labels, word lists, patterns and tables that decide results, as given."""

# ---- factions ---------------------------------------------------------------------------------
# Abbreviations that count as one faction.
MERGED_FACTION = "PRO"
MERGED_ABBREVIATIONS = ("PvdA", "GL", "GroenLinks-PvdA", "PRO")
# Parts of full names that count as one faction in the income star.
MERGED_NAME_PARTS = ("groenlinks", "partij van de arbeid", "progressief nederland")
MERGED_NAME = "GroenLinks / Progressief Nederland"
# Lower-case labels of one faction in the network view.
MERGED_LABELS = ("pro", "progressief nederland", "groenlinks-pvda", "groenlinks", "gl", "pvda", "partij van de arbeid")
# Channel names that mean the same.
MERGED_CHANNELS = {"x": "X (Twitter)", "twitter": "X (Twitter)"}

MEMBER_FUNCTION = "Tweede Kamerlid"
SENATOR_FUNCTION = "Eerste Kamerlid"
FIRST_SIGNATORY = "Eerste ondertekenaar"
FOR, AGAINST = "Voor", "Tegen"
DONE_STATUS = "Uitgevoerd"

# ---- decisions --------------------------------------------------------------------------------
# Outcome words, in matching order.
OUTCOMES = ("aangenomen", "verworpen", "aangehouden")
OUTCOME_PATTERN = r"(aangenomen|verworpen|aangehouden)"

# ---- income -----------------------------------------------------------------------------------
# Yearly factor by word in the frequency text, in matching order.
INCOME_FACTORS = {"maand": 12, "dag": 4}
MONTHLY_ONLY = {"maand": 12}

# ---- committees -------------------------------------------------------------------------------
# Committee type by name pattern (SQL LIKE on the lower-case name), star version.
COMMITTEE_TYPES_STAR = (
    ("Interparlementair", ("%interparlementair%",)),
    ("Tijdelijk", ("tijdelijke%", "%enquête%")),
    ("Vast", ("vaste commissie%",)),
)
COMMITTEE_TYPE_STAR_DEFAULT = "Overig"
# Committee type by name pattern, analysis version.
COMMITTEE_TYPES_ANALYSIS = (
    ("tijdelijk", ("%enquête%", "%tijdelijke%")),
    ("vast", ("vaste commissie%", "algemene commissie%", "commissie voor%")),
    ("interparlementair", ("delegatie%", "%groep%")),
)
COMMITTEE_TYPE_ANALYSIS_DEFAULT = "overig"
# Function codes with their labels, and name parts left out of chart labels.
FUNCTION_LABELS = {
    "OnderVz": "Ondervoorzitter",
    "PlvLid": "Plaatsvervangend lid",
    "EersteOndVzTk": "Eerste ondervoorzitter",
    "TweedeOndVzTk": "Tweede ondervoorzitter",
}
COMMITTEE_LABEL_PARTS = (("Vaste commissie voor ", ""), ("Tijdelijke commissie ", "Tijdelijk "))

# ---- side jobs --------------------------------------------------------------------------------
# Sector of a side job by words in its description; the first group with a hit wins.
SIDE_JOB_SECTORS = {
    "Zorg": ("ziekenhuis", "zorg", "gezondheid"),
    "Onderwijs": ("onderwijs", "school", "universiteit", "hogeschool"),
    "Financieel": ("bank", "verzekering", "financ", "management"),
    "Overheid": ("gemeente", "provincie", "waterschap", "kamer", "overheid"),
    "Maatschappelijk": ("stichting", "vereniging", "fonds", "ambassadeur", "vrijwillig"),
}
SIDE_JOB_DEFAULT = "Overig"

# ---- documents --------------------------------------------------------------------------------
# Document kind to group; other kinds get the default.
DOCUMENT_GROUPS = {
    "Advies Afdeling advisering Raad van State": "Advies Raad van State",
    "Advies Afdeling advisering Raad van State en Nader rapport": "Advies Raad van State",
    "Advies Afdeling advisering Raad van State en Reactie van de initiatiefnemer(s)": "Advies Raad van State",
    "Voorlichting Afdeling advisering Raad van State": "Advies Raad van State",
    "Advies van andere adviesorganen": "Advies overige adviesorganen",
    "Amendement": "Amendement",
    "Amendement (gewijzigd/nader/vervangend)": "Amendement",
    "Begrotingstoelichting": "Begroting en financiën",
    "Raming van de uitgaven": "Begroting en financiën",
    "Brief Algemene Rekenkamer": "Brief",
    "Brief commissie": "Brief",
    "Brief Eerste Kamer": "Brief",
    "Brief Europese Commissie": "Brief",
    "Brief Kamer": "Brief",
    "Brief lid / fractie": "Brief",
    "Brief Nationale ombudsman": "Brief",
    "Brief Presidium": "Brief",
    "Brief regering": "Brief",
    "EU-voorstel": "EU-voorstel",
    "Geleidende brief": "Geleidende brief",
    "Initiatiefnota": "Nota en initiatiefnota",
    "Jaarverslag": "Jaarverslag",
    "Koninklijke boodschap": "Koninklijke boodschap",
    "Lijst van vragen en antwoorden": "Vragen en antwoorden",
    "Verslag houdende een lijst van vragen en antwoorden": "Vragen en antwoorden",
    "Mededeling": "Mededeling",
    "Memorie van toelichting": "Memorie van toelichting",
    "Memorie van toelichting (initiatiefvoorstel)": "Memorie van toelichting",
    "Motie": "Motie",
    "Motie (gewijzigd/nader)": "Motie",
    "Nader rapport": "Nader rapport",
    "Nota": "Nota en initiatiefnota",
    "Nota n.a.v. het (nader/tweede nader/enz.) verslag": "Nota naar aanleiding van verslag",
    "Nota van verbetering": "Nota van wijziging en verbetering",
    "Nota van wijziging": "Nota van wijziging en verbetering",
    "Nota van wijziging (initiatiefvoorstel)": "Nota van wijziging en verbetering",
    "Oorspronkelijke tekst": "Wettekst en wetsvoorstel",
    "Voorstel van wet": "Wettekst en wetsvoorstel",
    "Voorstel van wet (initiatiefvoorstel)": "Wettekst en wetsvoorstel",
    "Voorstel van wet (tweede lezing)": "Wettekst en wetsvoorstel",
    "Verslag (initiatief)wetsvoorstel (nader)": "Verslag wetsvoorstel",
    "Rapport": "Rapport",
    "Rapport Algemene Rekenkamer": "Rapport",
    "Verslag van een algemeen overleg": "Verslag overleg",
    "Verslag van een commissiedebat": "Verslag overleg",
    "Verslag van een notaoverleg": "Verslag overleg",
    "Verslag van een schriftelijk overleg": "Verslag overleg",
    "Verslag van een wetgevingsoverleg": "Verslag overleg",
    "Verslag van een bijeenkomst": "Verslag overige activiteiten",
    "Verslag van een hoorzitting / rondetafelgesprek": "Verslag overige activiteiten",
    "Verslag van een rapporteur": "Verslag overige activiteiten",
    "Verslag van een werkbezoek": "Verslag overige activiteiten",
    "Voordracht": "Voordracht",
    "Voorstel tot wijziging Reglement van Orde": "Wijziging Reglement van Orde",
    "Overig": "Overig",
}
DOCUMENT_GROUP_DEFAULT = "Overig"
# Right-closed edges and labels of dossier lifespan classes, in days.
LIFESPAN_EDGES = (-1, 30, 182, 365, 1826, 100000)
LIFESPAN_LABELS = ("1. < 1 mnd", "2. 1-6 mnd", "3. 6-12 mnd", "4. 1-5 jaar", "5. > 5 jaar")

# ---- education --------------------------------------------------------------------------------
# Marks of an education that was not completed.
NOT_COMPLETED = r"niet voltooid|niet afgerond|onvoltooid|gestopt|afgebroken|\(\d+ jaar\)|propedeuse"
# Level by education text; the first pattern that matches wins.
EDUCATION_TEXT = (
    ("cursus",
     r"cursus|certificaat|training|leergang|workshop|masterclass|executive|postgraduate|postdoctoraal|postdoctoral|"
     r"\bnive\b|\bnima\b|coach|toezichthouder|mediation|ondernemersvaardigheden|basis ?kwalificatie|"
     r"register controller|erasmusbeurs|vooropleiding|secretaresse|bestuurder|management development|"
     r"management trainee|bijscholing|inservice|in-service|avondopleiding|avondcursus|beroepsopleiding|"
     r"kadertraining|management course|leadership course|summer school|introductie|\bminor\b"),
    ("promotie", r"promotie|phd|gepromoveerd|doctorate|doctoraat"),
    ("hbo", r"applied sciences|hoger beroepsonderwijs|higher vocational"),
    ("wo",
     r"master|msc|\bllm\b|doctoraal|\bdrs\b|\bir\b|ingenieur|bachelor|\bba\b|\bbsc\b|\bma\b|\bmba\b|\bmphil\b|"
     r"kandidaats|universitair|\bwo\b|universitaire|university|doctorandus"),
    ("hbo", r"\bhbo\b|hogeschool|pabo|\bhts\b|\bheao\b|\bhes\b|lerarenopleiding|kunstacademie|hotelschool"),
    ("mbo",
     r"\bk?mbo\b|\bmts\b|meao|middelbaar beroepsonderwijs|ambachtsschool|\bito\b|kleuterleidster|verpleegkundige|"
     r"spd[- ]bedrijfsadministratie|vakopleiding"),
    ("vo",
     r"mavo|havo|vwo|gymnasium|atheneum|\bhbs\b|mulo|lyceum|vmbo|\blbo\b|\bulo\b|middelbare|vbo|leao|mms|"
     r"algemeen voortgezet onderwijs|secondary school|secondary education|highschool|high school"),
    ("basisonderwijs", r"basisschool|lagere school|primary school|primary education"),
)
# Level by institution, used when the text gives none.
EDUCATION_INSTITUTION = (
    ("hbo",
     r"hogeschool|hogescholen|applied sciences|\bhbo\b|\bheao\b|\bhes\b|fontys|saxion|windesheim|avans|inholland|"
     r"\bhva\b|\bhu\b|hanze|academie van bouwkunst|hotelschool|militaire academie"),
    ("wo",
     r"universiteit|universitair|university|\buva\b|\bvu\b|\btu\b|erasmus|radboud|nyenrode|\bkub\b|\brug\b|"
     r"london school|school of economics|sorbonne|oxford|\beur\b"),
    ("mbo", r"\broc\b|\bmbo\b|koning willem|albeda"),
    ("vo",
     r"gymnasium|lyceum|\bmavo\b|\bhavo\b|\bvwo\b|\bvbo\b|\bleao\b|scholengemeenschap|college\b|middelbare school|"
     r"secondary school"),
    ("basisonderwijs", r"basisschool|primary school|lagere school|primary education"),
    ("cursus", r"ministerie|orde van advocaten|vereniging|stichting|psychodynamica|schoevers|sioo"),
)
# Canonical names of universities by pattern.
UNIVERSITIES = (
    ("Universiteit van Amsterdam", r"universiteit van amsterdam|\buva\b"),
    ("Vrije Universiteit Amsterdam", r"vrije universiteit(?! brussel)|\bvu\b"),
    ("Universiteit Leiden", r"leiden"),
    ("Erasmus Universiteit Rotterdam", r"erasmus"),
    ("Rijksuniversiteit Groningen", r"groningen"),
    ("Universiteit Utrecht", r"utrecht"),
    ("Radboud Universiteit", r"radboud|nijmegen"),
    ("Tilburg University", r"tilburg|brabant"),
    ("Universiteit Maastricht", r"maastricht"),
    ("Universiteit Twente", r"twente"),
    ("Wageningen University", r"wageningen"),
    ("TU Delft", r"delft"),
    ("Nyenrode Business Universiteit", r"nyenrode"),
    ("Open Universiteit", r"open universiteit"),
    ("University of Oxford", r"oxford"),
)
# Education levels with rank (only ranked levels count) and description.
EDUCATION_LEVELS = (
    ("basisonderwijs", 0, "Basisonderwijs"),
    ("vo", 1, "Voortgezet onderwijs"),
    ("mbo", 2, "MBO"),
    ("hbo", 3, "HBO"),
    ("wo", 4, "WO"),
    ("promotie", 5, "Promotie"),
    ("cursus", None, "Cursus of training (telt niet mee)"),
    ("niet_ingedeeld", None, "Niet ingedeeld"),
    ("onbekend", None, "Onbekend"),
)

# ---- careers ----------------------------------------------------------------------------------
# Career sectors with the flags inside politics and unclear.
SECTORS = (
    ("kamerlidmaatschap", True, False),
    ("politiek_ondersteuning", True, False),
    ("politiek_bestuur", True, False),
    ("media_communicatie", False, False),
    ("juridisch", False, False),
    ("onderwijs_wetenschap", False, False),
    ("zorg", False, False),
    ("overheid", False, False),
    ("maatschappelijk", False, False),
    ("veiligheid_defensie", False, False),
    ("bedrijfsleven en overige organisaties", False, False),
    ("bestuur_toezicht_onvoldoende_sectorcontext", False, True),
    ("overig_onvoldoende_sectorcontext", False, True),
    ("onbekend", False, False),
    ("niet_ingedeeld", False, False),
)
SECTOR_UNKNOWN, SECTOR_NONE = "onbekend", "niet_ingedeeld"
# The support sector counts only in a political context, and membership does not
# count for staff unless the function itself names a member.
SUPPORT_SECTOR, MEMBER_SECTOR = "politiek_ondersteuning", "kamerlidmaatschap"
POLITICAL_CONTEXT = (
    r"fractie|tweede kamer|eerste kamer|kamerlid|partij|campagne|verkiezing|wetenschappelijk bureau|"
    r"\b(?:vvd|pvda|cda|d66|sp|gl|groenlinks|pvv|christenunie|cu|sgp|volt|denk|bbb|fvd)\b")
STAFF_FUNCTION = (
    r"medewerk|adviseur|assistent|secretaris|voorlichter|woordvoerder|\bbeleid|speechschrijver|stagiair|campagne")
TRUE_MEMBER = r"\bkamerlid\b|\blid\b.*\bkamer\b|senaatslid"

# ---- places and rooms -------------------------------------------------------------------------
# Other spellings of place keys.
PLACE_ALIASES = {
    "den haag": "s gravenhage",
    "den bosch": "s hertogenbosch",
    "hertogenbosch": "s hertogenbosch",
    "gravenhage": "s gravenhage",
    "s heerenbergh": "s heerenberg",
    "driebergen": "driebergen rijsenburg",
    "capelle a d ijssel": "capelle aan den ijssel",
    "alphen a d rijn": "alphen aan den rijn",
    "willemstad n b": "willemstad",
    "cuijk en sint agatha": "cuijk",
    "cuijk en sint agata": "cuijk",
    "roosendaal en nispen": "roosendaal",
    "ginneken en bavel": "breda",
    "zuilen": "utrecht",
    "hillegersberg": "rotterdam",
    "jutphaas": "nieuwegein",
    "hoogezand sappemeer": "hoogezand",
    "beemster": "middenbeemster",
    "dantumadeel": "dantumadiel",
    "mijmegen": "nijmegen",
    "wonseradeel": "sudwest fryslan",
    "wymbritseradeel": "sudwest fryslan",
    "dongeradeel": "noardeast fryslan",
    "westdongeradeel": "noardeast fryslan",
    "doniawerstal": "de fryske marren",
}
# Match outcomes of a place.
PLACE_STATUS = {"none": "niet ingevuld", "match": "gematcht", "ambiguous": "niet eenduidig", "missing": "niet gevonden"}
# Other spellings of room keys, and display names by room key.
ROOM_ALIASES = {
    "klompzaal": "klompezaal",
    "wttewaallvanstoetwegenzaal": "wttewaalvanstoetwegenzaal",
}
ROOM_NAMES = {
    "plenairezaal": "Plenaire zaal",
    "thorbeckezaal": "Thorbeckezaal",
    "groenvanprinstererzaal": "Groen van Prinstererzaal",
    "troelstrazaal": "Troelstrazaal",
    "suzegroenewegzaal": "Suze Groenewegzaal",
    "wttewaalvanstoetwegenzaal": "Wttewaal van Stoetwegenzaal",
    "klompezaal": "Klompézaal",
    "enquetezaal": "Enquêtezaal",
    "alettajacobszaal": "Aletta Jacobszaal",
    "tilanuskamer": "Tilanuskamer",
    "vondelingkamer": "Vondelingkamer",
    "maxvanderstoelzaal": "Max van der Stoelzaal",
    "oudezaal": "Oude zaal",
    "k4zaal": "K4 zaal",
    "studiotolkgeberentaal": "Studio tolk Gebarentaal",
    "activiteitenkanaal": "Activiteitenkanaal",
    "plenairezaaltk": "Plenairezaal TK",
}
# Open, closed or unknown label of an activity.
OPENNESS = {True: "Besloten", False: "Openbaar", None: "Onbekend"}
