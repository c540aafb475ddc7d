"""The public tables. Names, types, nullability, defaults and keys of the data contract."""

from __future__ import annotations

from millrace.plans.contract import Table, columns

COUNTS = "minutes:int=0 goals_scored:int=0 assists:int=0 clean_sheets:int=0 goals_conceded:int=0 own_goals:int=0 penalties_saved:int=0 penalties_missed:int=0 yellow_cards:int=0 red_cards:int=0 saves:int=0 bonus:int=0 bps:int=0"
INDEX = "influence:float=0 creativity:float=0 threat:float=0 ict_index:float=0"
EXPECTED = "expected_goals:float=0 expected_assists:float=0 expected_goal_involvements:float=0 expected_goals_conceded:float=0"
DEFENCE = "tackles:int? clearances_blocks_interceptions:int? recoveries:int? defensive_contribution:int?"

PLAYERS = f"""
id:int first_name:str second_name:str web_name:str known_name:str? team:int team_code:int element_type:int now_cost:int price_change_percent:int?
status:str code:int opta_code:str? photo:str? birth_date:str? team_join_date:str? region:int? squad_number:int? special:bool? removed:bool?
can_transact:bool? can_select:bool? has_temporary_code:bool? total_points:int=0 event_points:int=0 {COUNTS} starts:int=0
tackles:int? recoveries:int? clearances_blocks_interceptions:int? defensive_contribution:int? dreamteam_count:int=0 in_dreamteam:bool=false
{INDEX} {EXPECTED}
clean_sheets_per_90:float? goals_conceded_per_90:float? saves_per_90:float? expected_goals_per_90:float? expected_assists_per_90:float?
expected_goal_involvements_per_90:float? expected_goals_conceded_per_90:float? defensive_contribution_per_90:float? starts_per_90:float?
form:float=0 points_per_game:float=0 selected_by_percent:float=0 value_form:float=0 value_season:float=0 ep_next:float? ep_this:float?
form_rank:int form_rank_type:int points_per_game_rank:int points_per_game_rank_type:int now_cost_rank:int now_cost_rank_type:int
selected_rank:int selected_rank_type:int influence_rank:int influence_rank_type:int creativity_rank:int creativity_rank_type:int
threat_rank:int threat_rank_type:int ict_index_rank:int ict_index_rank_type:int
chance_of_playing_next_round:int? chance_of_playing_this_round:int? transfers_in:int=0 transfers_out:int=0 transfers_in_event:int=0 transfers_out_event:int=0
cost_change_event:int=0 cost_change_event_fall:int=0 cost_change_start:int=0 cost_change_start_fall:int=0
penalties_order:int? penalties_text:str? corners_and_indirect_freekicks_order:int? corners_and_indirect_freekicks_text:str?
direct_freekicks_order:int? direct_freekicks_text:str? news:str? news_added:str?
"""
TEAMS = """
id:int name:str short_name:str code:int pulse_id:int? strength:int strength_overall_home:int strength_overall_away:int strength_attack_home:int
strength_attack_away:int strength_defence_home:int strength_defence_away:int played:int=0 win:int=0 draw:int=0 loss:int=0 points:int=0 position:int
form:float? team_division:str? unavailable:bool
"""
FIXTURES = """
id:int code:int event:int? team_h:int team_a:int team_h_score:int? team_a_score:int? team_h_difficulty:int team_a_difficulty:int kickoff_time:str?
minutes:int=0 started:bool? finished:bool finished_provisional:bool provisional_start_time:bool? pulse_id:int?
"""
FIXTURE_STATS = "fixture_id:int identifier:str element:int value:int side:str"
EVENTS = """
id:int name:str deadline_time:str deadline_time_epoch:int deadline_time_game_offset:int release_time:str? released:bool? average_entry_score:int?
highest_score:int? highest_scoring_entry:int? ranked_count:int? finished:bool data_checked:bool is_previous:bool is_current:bool is_next:bool
can_enter:bool can_manage:bool cup_leagues_created:bool h2h_ko_matches_created:bool most_selected:int? most_transferred_in:int? most_captained:int?
most_vice_captained:int? top_element:int? top_element_points:int? transfers_made:int=0 chip_plays_json:str?
"""
ELEMENT_TYPES = """
id:int singular_name:str singular_name_short:str plural_name:str plural_name_short:str squad_select:int squad_min_select:int!? squad_max_select:int!?
squad_min_play:int squad_max_play:int ui_shirt_specific:bool element_count:int
"""
GAMEWEEKS = f"element_id:int<element round:int {COUNTS} total_points:int=0 {INDEX} {EXPECTED} starts:int=0 in_dreamteam:bool=false {DEFENCE}"
PLAYER_HISTORIES = f"""
element_id:int<element round:int fixture:int {COUNTS} total_points:int=0 {INDEX} {EXPECTED} starts:int=0 in_dreamteam:bool=false {DEFENCE}
opponent_team:int was_home:bool kickoff_time:str team_h_score:int? team_a_score:int? value:int selected:int transfers_in:int transfers_out:int transfers_balance:int
"""

TABLES = (
    Table("players", columns(PLAYERS), ("id",), "one row per player", drop_prefixes=("scout_",), notes={"now_cost": "tenths of millions", "element_type": "position code 1 to 4"}),
    Table("teams", columns(TEAMS), ("id",), "one row per team"),
    Table("fixtures", columns(FIXTURES), ("id",), "one row per fixture", cluster_by=("event",), drop_keys=("stats",)),
    Table("fixture_stats", columns(FIXTURE_STATS), ("fixture_id", "identifier", "element"), "one row per fixture, statistic and player", cluster_by=("element",)),
    Table("gameweeks", columns(GAMEWEEKS), ("element_id", "round"), "one row per player and round", cluster_by=("round",)),
    Table("player_histories", columns(PLAYER_HISTORIES), ("element_id", "round", "fixture"), "one row per player, round and fixture", cluster_by=("round", "element_id"), drop_keys=("modified",)),
    Table("events", columns(EVENTS), ("id",), "one row per round of the season", drop_keys=("chip_plays", "top_element_info", "overrides"), notes={"is_current": "1 for the current round"}),
    Table("element_types", columns(ELEMENT_TYPES), ("id",), "one row per position", drop_keys=("sub_positions_locked",)),
)
