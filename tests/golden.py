"""The hand-counted case."""

from __future__ import annotations

SONGS = '''track_id,track_genre,duration_ms,track_name,artists
t1,pop,200000,Alpha,Ann
t2,pop,180000,"Beta ""live"", cut",Bob;Cy
t3,rock,240000,Gamma,Dee
t4,pop,100000,Delta,Eve
t5,pop,90000,Epsilon,Flo
t6,,150000,NoGenre,Gus
t7,rock,oops,BadMs,Hal
t8,jazz,300000,Theta,Ivy
t8,pop,300000,Theta,Ivy
'''

STREAMS = """user_id,track_id,listen_time
u1,t1,2024-01-15 10:00:00
u1,t1,2024-01-15 11:00:00
u2,t1,2024-01-15 12:00:00
u2,t2,2024-01-15 12:05:00
u3,t4,2024-01-15 13:00:00
u3,t5,2024-01-15 13:10:00
u1,t3,2024-01-15 14:00:00
u1,t6,2024-01-15 14:10:00
u1,t7,2024-01-15 14:20:00
u9,t99,2024-01-15 14:30:00
,t3,2024-01-15 15:00:00
u4,t8,2024-01-16 00:00:00
u5,t1,not-a-time
"""

KPIS = [
    ("jazz", "2024-01-16", 1, 1, 300000, 300000),
    ("pop", "2024-01-15", 6, 3, 970000, 323333),
    ("pop", "2024-01-16", 1, 1, 300000, 300000),
    ("rock", "2024-01-15", 2, 1, 480000, 480000),
]

TOP_SONGS = [
    ("jazz#2024-01-16", 1, "t8", "Theta", 1),
    ("pop#2024-01-15", 1, "t1", "Alpha", 3),
    ("pop#2024-01-15", 2, "t5", "Epsilon", 1),
    ("pop#2024-01-15", 3, "t4", "Delta", 1),
    ("pop#2024-01-16", 1, "t8", "Theta", 1),
    ("rock#2024-01-15", 1, "t3", "Gamma", 2),
]

TOP_GENRES = [
    ("2024-01-15", 1, "pop", 6),
    ("2024-01-15", 2, "rock", 2),
    ("2024-01-16", 1, "pop", 1),
    ("2024-01-16", 2, "jazz", 1),
]
