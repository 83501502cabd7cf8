"""Short SQL fragments shared by the twins: sums of money are taken in DECIMAL."""


def DEC2(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def dsum(x: str, scale: int = 2) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def davg(x: str, scale: int = 2) -> str:
    return f"({dsum(x, scale)} / COUNT({x}))"
