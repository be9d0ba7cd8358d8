from plantpulse.functions.labels import *  # noqa: F401,F403
from plantpulse.functions.temperature import *  # noqa: F401,F403
from plantpulse.functions.text import *  # noqa: F401,F403
from plantpulse.functions.timecols import *  # noqa: F401,F403
