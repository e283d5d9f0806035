"""A rate that all tasks of a run keep together, without talking to each other."""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass

#: A call may begin so much of a slot's length late; slots are longer by as much, so that late calls keep the rate too.
LATE = 0.2


@dataclass(frozen=True)
class Slots:
    """Times at which calls may begin, dealt to the tasks in turn from a start that all of them know.

    Task i of `tasks` has every tasks-th slot. Of any n + 1 calls the first and
    the last begin at least n / rate seconds apart, whichever tasks make them and
    however many run at once; slots of tasks that do not run are lost, so there
    should be no more tasks than cores. Clocks of the machines should agree to
    a part of a slot. A task's second attempt begins with slots to come;
    speculative copies of a task would share its slots and are refused.
    """

    start: float
    rate: float
    tasks: int

    @classmethod
    def from_now(cls, rate: float, tasks: int) -> Slots:
        if rate <= 0 or tasks < 1:
            raise ValueError("a rate and a number of tasks are needed")
        return cls(time.time(), rate, tasks)

    def of(self, task: int) -> Pace:
        return Pace(self, task)


class Pace:
    """One task's slots; wait() returns when the next one has come."""

    def __init__(self, slots: Slots, task: int, clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep) -> None:
        self._length, self._late = (1 + LATE) / slots.rate, LATE / slots.rate
        self._first, self._every = slots.start + task % slots.tasks * self._length, slots.tasks * self._length
        self._next, self._clock, self._sleep = 0, clock, sleep

    def wait(self) -> float:
        """The time at which the call begins."""
        while True:
            now = self._clock()
            self._next = max(self._next, math.ceil((now - self._late - self._first) / self._every))
            slot = self._first + self._next * self._every
            if slot > now:
                self._sleep(slot - now)
                now = self._clock()
            if slot <= now <= slot + self._late:
                self._next += 1
                return now


def no_wait() -> float:
    return time.time()


def task_wait(slots: Slots | None) -> Callable[[], float]:
    """wait() of the task that runs this, or one that does not wait."""
    if slots is None:
        return no_wait
    from pyspark import TaskContext

    return slots.of(TaskContext.get().partitionId()).wait


def shared_slots(spark, rate: float | None, tasks: int) -> Slots | None:
    """The slots of a run at a rate; none without a rate."""
    if rate is None:
        return None
    if spark.conf.get("spark.speculation", "false") == "true":
        raise ValueError("a rate cannot be kept with spark.speculation: two copies of a task would call in the same slots")
    return Slots.from_now(rate, tasks)
