"""Names, patterns and class markers that results must agree on."""

# Class markers of the game page.
GROUP_CLASS = (
    "game-box-scores-table-grouped-column_tableGroupedColumnStatGroupContainer__Oci84"
)
ROW_CLASS = (
    "game-box-scores-table-grouped-column_tableGroupedRowStatGroupContainer__wluIz"
)
HEADING_CLASS = "game-box-scores-table-grouped-column_groupedTableHeading__XTxR_"
CELL_CLASS = "game-box-scores-table-grouped-column_tableStatCell__4zJlJ"
PLAYER_LINK_CLASS = "game-box-scores-table-grouped-tab_playerLink__MqVrl"
NAMES_CLASS = (
    "game-box-scores-table-grouped-tab_tableGroupedRowsContainer__rmPnn "
    "game-box-scores-table-grid-sizing_tableGridSizing__KbFAw"
)
CLUB_CLASS = "club-info_name__xB4rz"
INFO_CLASS = "event-info_listItem__Iu4ou"

# Patterns.
GAME_LINK = r"/euroleague/game-center/\d\d\d\d-\d\d/[\w-]+/E\d\d\d\d/[\d]{1,3}/"
PLAYER_LINK = r"/euroleague/players/([\w-]+)/[\d\w]+/"
# Years of more than four digits too, as many as fit an int.
LINK_SEASON = r"/E(\d{4,9})/"
ROUND_NUMBER = r"\d{1,2}"
DATE_FORMAT = "d MMM yyyy"
PERCENT = r"([\d.]+)"
CLOCK = r"(\d+):(\d+)"
MADE_ATTEMPTED = r"(\d{1,2})/(\d{1,2})"

# Page layout.
GROUPS_PER_SIDE = 9
LEADING_NAME_ROWS = 2
TEAM_ROW = "Team"
TOTAL_ROW = "Total"
LAST_ROUND = 34

# The twenty statistics of a page row, in page order.
PAGE_STATS = [
    "Minutes", "Points",
    "2P_Made/Attempted", "2P_Percentage",
    "3P_Made/Attempted", "3P_Percentage",
    "FTP_Made/Attempted", "FTP_Percentage",
    "O_Rebounds", "D_Rebounds", "Total_Rebounds",
    "Assists", "Steals", "Turnovers",
    "Blocks", "ReceivedBlocks",
    "FoulsCommited", "FoulReceived",
    "Effectivity", "PlusMinus",
]

# Columns of the typed box score, in output order.
BOXSCORE_COLUMNS = [
    "Player", "Seconds", "Points",
    "TwoPMakes", "TwoPAttempts", "2P_Percentage",
    "ThreePMakes", "ThreePAttempts", "3P_Percentage",
    "FTMakes", "FTAttempts", "FTP_Percentage",
    "O_Rebounds", "D_Rebounds", "Total_Rebounds",
    "Assists", "Steals", "Turnovers", "Blocks", "ReceivedBlocks",
    "FoulsCommited", "FoulReceived", "Effectivity", "PlusMinus",
    "Team", "Opponent", "Home", "Date", "Round", "GameTime",
]

# Columns that stay text in the raw table and are numbers in the features.
TEXT_NUMBERS = [
    "Round", "TwoPMakes", "TwoPAttempts", "ThreePMakes", "ThreePAttempts",
    "FTMakes", "FTAttempts",
]

# Measures with a team average; players have `Seconds` in front.
TEAM_MEASURES = [
    c for c in BOXSCORE_COLUMNS[2:BOXSCORE_COLUMNS.index("Team")]
]
PLAYER_MEASURES = ["Seconds"] + TEAM_MEASURES


def average_name(measure):
    """Output name of a running average: only Seconds and Points are lowered."""
    lowered = {"Seconds": "seconds", "Points": "points"}
    return "avg_" + lowered.get(measure, measure)


# The season sheet.
SHEET_KEY = "TEAM"
SHEET_STATS = [
    "PACE", "POSS", "OFF RTG", "DEF RTG", "NET RTG", "OR%", "DR%", "TR%",
    "AST%", "AST Ratio", "AST/TO", "TO Ratio", "ST%",
    "PF 100 Poss", "DF 100 Poss", "BLK%",
]
SHEET_PERCENTS = ["ST%", "BLK%"]
