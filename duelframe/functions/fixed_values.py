"""Name lists that decide which labels mean the same team.

They are data, not logic. Nickname and city aliases that follow from a full name by
rule are derived in ``operators/entities.py`` and are not listed here.
"""

# Abbreviation -> full name.
PRO_ABBREVIATIONS = {
    "ARI": "Arizona Cardinals",
    "ATL": "Atlanta Falcons",
    "BAL": "Baltimore Ravens",
    "BUF": "Buffalo Bills",
    "CAR": "Carolina Panthers",
    "CHI": "Chicago Bears",
    "CIN": "Cincinnati Bengals",
    "CLE": "Cleveland Browns",
    "DAL": "Dallas Cowboys",
    "DEN": "Denver Broncos",
    "DET": "Detroit Lions",
    "GB": "Green Bay Packers",
    "HOU": "Houston Texans",
    "IND": "Indianapolis Colts",
    "JAX": "Jacksonville Jaguars",
    "KC": "Kansas City Chiefs",
    "LV": "Las Vegas Raiders",
    "LVR": "Las Vegas Raiders",
    "LAC": "Los Angeles Chargers",
    "LAR": "Los Angeles Rams",
    "MIA": "Miami Dolphins",
    "MIN": "Minnesota Vikings",
    "NE": "New England Patriots",
    "NO": "New Orleans Saints",
    "NYG": "New York Giants",
    "NYJ": "New York Jets",
    "PHI": "Philadelphia Eagles",
    "PIT": "Pittsburgh Steelers",
    "SEA": "Seattle Seahawks",
    "SF": "San Francisco 49ers",
    "TB": "Tampa Bay Buccaneers",
    "TEN": "Tennessee Titans",
    "WAS": "Washington Commanders",
    "WSH": "Washington Commanders",
}

# Free-text aliases no rule gives (lookup form -> full name).
PRO_SYNONYMS = {
    "l a rams": "Los Angeles Rams",
    "la rams": "Los Angeles Rams",
    "st louis rams": "Los Angeles Rams",
    "saint louis rams": "Los Angeles Rams",
    "la chargers": "Los Angeles Chargers",
    "l a chargers": "Los Angeles Chargers",
    "los angeles raiders": "Las Vegas Raiders",
    "oakland raiders": "Las Vegas Raiders",
    "washington football team": "Washington Commanders",
    "washington redskins": "Washington Commanders",
    "redskins": "Washington Commanders",
    "football team": "Washington Commanders",
    "ny giants": "New York Giants",
    "ny jets": "New York Jets",
    "bucs": "Tampa Bay Buccaneers",
    "niners": "San Francisco 49ers",
    "sf 49ers": "San Francisco 49ers",
    "san fran 49ers": "San Francisco 49ers",
    "bucaneers": "Tampa Bay Buccaneers",
    "buccs": "Tampa Bay Buccaneers",
}

# City labels shared by two teams, or of a former home.
PRO_CITIES = {
    "la": "Los Angeles Rams",
    "los angeles": "Los Angeles Rams",
    "saint louis": "Los Angeles Rams",
    "st louis": "Los Angeles Rams",
    "oakland": "Las Vegas Raiders",
    "ny": "New York Giants",
    "new york": "New York Giants",
}

# College label -> display name.
COLLEGE_DISPLAY = {
    "alabama": "Alabama Crimson Tide",
    "clemson": "Clemson Tigers",
    "georgia": "Georgia Bulldogs",
    "notre dame": "Notre Dame Fighting Irish",
    "ohio state": "Ohio State Buckeyes",
    "usc": "USC Trojans",
    "texas": "Texas Longhorns",
    "oregon": "Oregon Ducks",
}

# Bookmaker spelling (spaces kept or dropped) -> college label.
COLLEGE_FEED_ALIASES = {
    "umass": "massachusetts",
    "buffalo": "buffalo",
    "appalachianstate": "app state",
    "coastalcarolina": "coastal carolina",
    "indianahoosiers": "indiana",
    "michiganstate": "michigan state",
    "louisiana": "louisiana",
    "southernmississippi": "southern miss",
    "virginiacavaliers": "virginia",
    "washingtonstate": "washington state",
    "uclabruins": "ucla",
    "marylandterrapins": "maryland",
    "alabamacrimsontide": "alabama",
    "tennesseevolunteers": "tennessee",
    "syracuseorange": "syracuse",
    "pittsburgh": "pittsburgh",
    "byu": "byu",
    "utahutes": "utah",
    "newmexicolobos": "new mexico",
    "nevadawolfpack": "nevada",
    "oregonstatebeavers": "oregon state",
    "lafayetteleopards": "lafayette",
    "stanfordcardinal": "stanford",
    "floridastate": "florida state",
    "miami (oh) redhawks": "miami (oh)",
    "liberty flames": "liberty",
    "brigham young cougars": "byu",
    "byu cougars": "byu",
    "central florida golden knights": "ucf",
    "central florida knights": "ucf",
    "utsa roadrunners": "utsa",
    "texas san antonio roadrunners": "utsa",
    "texas a&m aggies": "texas a&m",
    "southern cal": "usc",
    "usc trojans": "usc",
    "unlv rebels": "unlv",
    "ole miss rebels": "ole miss",
    "southern miss golden eagles": "southern miss",
    "louisiana lafayette": "louisiana",
    "louisiana ragin cajuns": "louisiana",
    "vanderbilt commodores": "vanderbilt",
    "charlotte 49ers": "charlotte",
    "south carolina gamecocks": "south carolina",
    "south florida bulls": "south florida",
    "kent state golden flashes": "kent state",
    "texas tech red raiders": "texas tech",
    "pittsburgh panthers": "pittsburgh",
    "western kentucky hilltoppers": "western kentucky",
    "boise state broncos": "boise state",
    "louisiana monroe warhawks": "louisiana monroe",
    "michigan state spartans": "michigan state",
    "wisconsin badgers": "wisconsin",
    "penn state nittany lions": "penn state",
    "arizona state sun devils": "arizona state",
    "north texas mean green": "north texas",
    "rutgers scarlet knights": "rutgers",
    "colorado state rams": "colorado state",
    "hawaii rainbow warriors": "hawaii",
    "southern mississippi": "southern miss",
}

# Nickname suffixes of two words.
COLLEGE_SUFFIX_PHRASES = [
    "blue devils", "yellow jackets", "horned frogs", "green wave", "black knights", "golden gophers",
    "golden eagles", "golden bears", "golden flashes", "thundering herd", "sun devils", "mean green",
    "rainbow warriors", "scarlet knights", "nittany lions", "crimson tide", "fighting illini", "blue hens",
    "blue raiders", "tar heels", "demon deacons",
]

# Nickname suffixes of one word.
COLLEGE_SUFFIX_WORDS = [
    "aggies", "bluehens", "broncos", "bruins", "cardinal", "cavaliers", "hilltoppers", "hokies", "jaguars",
    "leopards", "badgers", "bears", "boilermakers", "buckeyes", "bulls", "chanticleers", "chippewas",
    "buffaloes", "crimson", "dukes", "hawks", "hawkeyes", "devils", "jackets", "gophers", "cornhuskers",
    "wave", "knights", "frogs", "rebels", "trojans", "bulldogs", "tigers", "gators", "cougars", "cardinals",
    "hurricanes", "eagles", "falcons", "warhawks", "rockets", "minutemen", "mountaineers", "cowboys",
    "sooners", "spartans", "wolverines", "huskies", "panthers", "wildcats", "razorbacks", "bearcats",
    "ducks", "lions", "herd", "bobcats", "zips", "seminoles", "longhorns", "blazers", "mustangs", "monarchs",
    "rams", "gamecocks", "cyclones", "jayhawks", "owls", "warriors", "tide", "orange", "lobos", "tarheels",
    "volunteers", "utes", "wolfpack", "terrapins",
]

# Ratings-page key -> schedule key.
COLLEGE_KEY_OVERRIDES = {
    "appalachianstate": "appstate",
    "armywestpoint": "army",
    "centralfloridaucf": "ucf",
    "connecticut": "uconn",
    "flainternational": "floridainternational",
    "louisianalafayette": "louisiana",
    "louisianamonroeulm": "ulmonroe",
    "miamiflorida": "miami",
    "miamiohio": "miamioh",
    "mississippi": "olemiss",
    "samhoustonstate": "samhouston",
    "sanjosestate": "sanjosstate",
    "southerncalifornia": "usctrojans",
}
