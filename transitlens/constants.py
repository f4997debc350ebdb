"""Reference values and thresholds.

Everything under "FIXED VALUES" must equal what the reference pipeline uses,
otherwise distances, zones, SLAs, dwell expectations and labels change.
They are stated as plain data, in their natural order.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES (must match the reference data model)
# --------------------------------------------------------------------------

# City coordinates (city, latitude, longitude); the position in this list is
# the city index used by the test-data mapping.
CITIES = [
    ("Delhi", 28.6139, 77.2090),
    ("Noida", 28.5355, 77.3910),
    ("Gurgaon", 28.4595, 77.0266),
    ("Faridabad", 28.4089, 77.3178),
    ("Ghaziabad", 28.6692, 77.4538),
    ("Ludhiana", 30.9010, 75.8573),
    ("Amritsar", 31.6340, 74.8723),
    ("Jalandhar", 31.3260, 75.5762),
    ("Chandigarh", 30.7333, 76.7794),
    ("Jaipur", 26.9124, 75.7873),
    ("Jodhpur", 26.2389, 73.0243),
    ("Udaipur", 24.5854, 73.7125),
    ("Lucknow", 26.8467, 80.9462),
    ("Kanpur", 26.4499, 80.3319),
    ("Varanasi", 25.3176, 82.9739),
    ("Agra", 27.1767, 78.0081),
    ("Indore", 22.7196, 75.8577),
    ("Bhopal", 23.2599, 77.4126),
    ("Nagpur", 21.1458, 79.0882),
    ("Raipur", 21.2514, 81.6296),
    ("Mumbai", 19.0760, 72.8777),
    ("Pune", 18.5204, 73.8567),
    ("Nashik", 19.9975, 73.7898),
    ("Ahmedabad", 23.0225, 72.5714),
    ("Surat", 21.1702, 72.8311),
    ("Vadodara", 22.3072, 73.1812),
    ("Rajkot", 22.3039, 70.8022),
    ("Kolkata", 22.5726, 88.3639),
    ("Patna", 25.5941, 85.1376),
    ("Ranchi", 23.3441, 85.3096),
    ("Jamshedpur", 22.8046, 86.2029),
    ("Bhubaneswar", 20.2961, 85.8245),
    ("Guwahati", 26.1445, 91.7362),
    ("Bengaluru", 12.9716, 77.5946),
    ("Chennai", 13.0827, 80.2707),
    ("Hyderabad", 17.3850, 78.4867),
    ("Coimbatore", 11.0168, 76.9558),
    ("Kochi", 9.9312, 76.2673),
    ("Visakhapatnam", 17.6868, 83.2185),
    ("Madurai", 9.9252, 78.1198),
]

# Hub master (hub_id, hub_name, city, region, hub_type, expected_dwell_hrs,
# max_capacity, operating_shift). Cities without a row have no hub_id.
HUBS = [
    ("HUB001", "Delhi Sorting Center", "Delhi", "North", "SORTING", 2, 6000, "24x7"),
    ("HUB002", "Mumbai Gateway Hub", "Mumbai", "West", "SORTING", 3, 7000, "24x7"),
    ("HUB003", "Bengaluru Tech Hub", "Bengaluru", "South", "SORTING", 2, 5000, "24x7"),
    ("HUB004", "Nagpur Central Sorting", "Nagpur", "Central", "SORTING", 2, 3500, "24x7"),
    ("HUB005", "Kolkata East Sorting Hub", "Kolkata", "East", "SORTING", 2, 4500, "24x7"),
    ("HUB006", "Chennai South Gateway", "Chennai", "South", "SORTING", 2, 4000, "24x7"),
    ("HUB007", "Hyderabad Distribution Hub", "Hyderabad", "South", "DELIVERY", 1, 2000, "Day"),
    ("HUB008", "Ahmedabad Sorting Hub", "Ahmedabad", "West", "SORTING", 2, 3500, "24x7"),
    ("HUB009", "Pune Delivery Center", "Pune", "West", "DELIVERY", 1, 2500, "Day"),
    ("HUB010", "Jaipur North Hub", "Jaipur", "North", "SORTING", 2, 2500, "24x7"),
    ("HUB013", "Kochi Delivery Hub", "Kochi", "South", "DELIVERY", 1, 3000, "Day"),
    ("HUB014", "Nashik Delivery Hub", "Nashik", "West", "DELIVERY", 1, 2800, "Day"),
    ("HUB015", "Amritsar Delivery Hub", "Amritsar", "North", "DELIVERY", 1, 1200, "Day"),
    ("HUB016", "Chandigarh Sorting Hub", "Chandigarh", "North", "SORTING", 3, 2000, "24x7"),
    ("HUB017", "Lucknow Distribution Hub", "Lucknow", "North", "SORTING", 2, 2800, "24x7"),
    ("HUB018", "Indore Central Hub", "Indore", "Central", "SORTING", 2, 2200, "24x7"),
]

# Carriers, in the order the test-data mapping indexes them.
CARRIERS = ["BlueDart", "DTDC", "DHL", "Delhivery", "Ecom Express"]

SHIPMENT_TYPES = ["Express", "Standard", "Economy"]

# Zone upper bounds in road km (inclusive); anything beyond is the last zone.
ZONE_BOUNDS = [(50.0, "Local"), (300.0, "Zone A"), (800.0, "Zone B"), (1500.0, "Zone C")]
ZONE_BEYOND = "Zone D"

# SLA rate card: zone -> (Express, Standard, Economy) hours.
SLA_RATE_CARD = {
    "Local": (12, 24, 48),
    "Zone A": (24, 48, 72),
    "Zone B": (36, 72, 96),
    "Zone C": (48, 96, 120),
    "Zone D": (72, 120, 168),
}

# Road distance = geodesic distance x this factor, rounded to 0.1 km.
ROAD_FACTOR = 1.3
# WGS-84 ellipsoid.
WGS84_A_KM = 6378.137
WGS84_F = 1 / 298.257223563

# Average truck speed used for the expected travel time between hubs.
TRUCK_SPEED_KMPH = 40

# Scan types and the hub-stay pairs (scan, next scan) that make a stay.
PICKED_UP, ARRIVED, DEPARTED, DELIVERED = "PICKED_UP", "ARRIVED", "DEPARTED", "DELIVERED"
STAY_PAIRS = [(PICKED_UP, DEPARTED), (ARRIVED, DEPARTED), (ARRIVED, DELIVERED)]

# Delay categories (silver) and their upper bounds in hours (inclusive).
NORMAL, MINOR_DELAY, MAJOR_DELAY = "normal", "minor_delay", "major_delay"
NORMAL_MAX_HRS = 1
MINOR_MAX_HRS = 4

# Delay profiles counted as delayed by the gold rollups, and the gold
# threshold above which a stay's whole-hour delay is summed.
DELAYED_PROFILES = ["major", "minor"]
GOLD_DELAY_MIN_HRS = 2

# Visibility labels (spelling kept verbatim: users filter on them).
STARTING_POINT = "Staring Point"
FINAL_DELIVERY = "Final Delivery"
SAME_HUB = "Same Hub Movement"
DARK_PERIOD = "Dark Period"
NORMAL_VISIBILITY = "Normal"

# Delivery SLA labels.
SLA_BREACH = "SLA Breach"
SLA_COMPLETED = "SLA Completed"
SLA_EXACT = "SLA Met Exactly"

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
