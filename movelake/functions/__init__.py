from movelake.functions.rules import *  # noqa: F401,F403
from movelake.functions.geo import *  # noqa: F401,F403
