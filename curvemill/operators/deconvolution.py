"""Residue curves by regularised deconvolution: flow, volume, transit time and its spread.

A residue is a cubic spline; its coefficients x minimise |D x - c|^2 + w^2 |L x|^2, with D the convolution of the input
curve with the splines and L first differences. D and L are brought to diagonal form together once an input curve and delay,
through the QR factors of both stacked and a singular value decomposition. Every weight w then costs a product of vectors:
misfit, penalty, degrees of freedom and evidence are sums over the singular values, and curves are rows of one matrix product.
"""

from __future__ import annotations

import numpy as np

from curvemill.operators.filters import shift_rows
from curvemill.operators.fitting import Model, register_model

#: Named bundles of options; an option given beside a bundle wins.
PRESETS = {
    "default": {"selection": "gcv", "spacing": "log", "moments": "central_volume"},
    "bayes": {"selection": "evidence", "spacing": "log", "moments": "central_volume", "flow_sd": True},
    "legacy": {"selection": "lcurve", "spacing": "linear", "lowest": 0.05, "highest": 40.0, "weights": 121, "moments": "residue_integral"},
    "matlab": {"selection": "lcurve", "spacing": "linear", "exact": True},
}
_OPTIONS = {
    "preset": "default", "weights": None, "lowest": None, "highest": None, "selection": None, "spacing": None, "moments": None, "exact": None, "flow_sd": None,
    "delay_step": 0.05, "flow_frames": 50, "density": 1.04, "hematocrit": 0.42, "plasma": False, "samples": 0, "upsample": 1,
}
_TINY = 1e-30


def spline_basis(knots: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Cubic splines on clamped knots at the points ``at``: one row a spline; the last knot belongs to no interval."""
    knots = np.concatenate([[knots[0]] * 3, knots, [knots[-1]] * 3])
    b = ((knots[:-1, None] <= at) & (at < knots[1:, None])).astype(float)
    for order in range(2, 5):
        width = knots[order - 1 :] - knots[: 1 - order]
        up = np.divide(at - knots[: 1 - order, None], width[:, None], out=np.zeros((len(width), len(at))), where=width[:, None] > 0)
        b = up[:-1] * b[:-1] + (1 - up[1:]) * np.where(width[1:, None] > 0, b[1:], 0.0)
    return b


def convolution_matrix(c_a: np.ndarray) -> np.ndarray:
    lag = np.arange(len(c_a))[:, None] - np.arange(len(c_a))
    return np.where(lag >= 0, c_a[np.maximum(lag, 0)], 0.0)


def _design(c_a: np.ndarray, t: np.ndarray, delay: float, basis: np.ndarray, w: np.ndarray) -> dict:
    shifted = shift_rows(c_a[None, :], t, delay)[0] if delay else c_a
    d = convolution_matrix(shifted) @ basis.T
    penalty = np.diff(np.eye(d.shape[1]), axis=0)
    q, r = np.linalg.qr(np.vstack([d, penalty]))
    u, c, wt = np.linalg.svd(q[: len(d)], full_matrices=False)
    c2 = np.minimum(c, 1.0) ** 2
    s2 = 1 - c2
    den = c2 + w[:, None] ** 2 * s2
    return {
        "c_a": shifted, "u": u, "c": c, "den": den, "back": np.linalg.solve(r, wt.T), "w2": w[:, None] ** 2, "s2": s2, "freedom": len(d) - (c2 / den).sum(1),
        "log_det": 2 * np.log(np.abs(np.diag(r)) + _TINY).sum() + np.log(den).sum(1), "rank": len(penalty),
    }


def prepare(c_a: np.ndarray, t: np.ndarray, **given) -> dict | None:
    if given["preset"] not in PRESETS:
        raise ValueError(f"preset must be one of {sorted(PRESETS)}")
    o = {"weights": 121, "lowest": 1e-3, "exact": False, "flow_sd": False, "moments": "central_volume", **PRESETS[given["preset"]], **{k: v for k, v in given.items() if v is not None}}
    if o["selection"] not in ("gcv", "lcurve", "evidence") or o["moments"] not in ("central_volume", "residue_integral"):
        raise ValueError("selection must be gcv, lcurve or evidence, moments central_volume or residue_integral")
    n = len(t)
    if n < 5 or not t[1] > t[0] or not np.isfinite(c_a).all():
        return None
    dt = float(t[1] - t[0])
    top = o["highest"] if o.get("highest") else np.linalg.svd(convolution_matrix(c_a), compute_uv=False)[0]
    top = max(float(top), o["lowest"])
    w = np.geomspace(o["lowest"], top, o["weights"]) if o["spacing"] == "log" else np.linspace(o["lowest"], top, o["weights"])
    if not w[1] > w[0]:
        return None
    end = float(n) if o["exact"] else t[-1]  # "exact" has its knots up to the number of frames
    knots = 5 * dt * np.arange(int(np.floor(end / (5 * dt) + 1e-12)) + 1)
    basis = spline_basis(knots if len(knots) >= 3 else 5 * dt * np.arange(3), t)
    unit = np.log(w[1] / w[0]) if o["spacing"] == "log" else w[1] - w[0]
    return {**o, "given": c_a, "t": t, "dt": dt, "w": w, "basis": basis, "unit": unit, "designs": {}, "scale": 6000 * (1 - o["hematocrit"] if o["plasma"] else 1.0) / o["density"]}


def _corner(misfit: np.ndarray, penalty: np.ndarray, unit: float) -> np.ndarray:
    """The weight at which the curve of log misfit against log penalty bends most; places without a bend never win."""
    x, y = np.log(np.maximum(misfit, _TINY)), np.log(np.maximum(penalty, _TINY))
    dx, dy = np.diff(x, axis=1)[:, :-1] / unit, np.diff(y, axis=1)[:, :-1] / unit
    ddx, ddy = np.diff(x, n=2, axis=1) / unit**2, np.diff(y, n=2, axis=1) / unit**2
    size = (dx**2 + dy**2) ** 1.5
    bend = np.divide(dx * ddy - ddx * dy, size, out=np.full_like(size, -np.inf), where=size > 0)
    return np.where(np.isfinite(bend), bend, -np.inf).argmax(1)


def residue_mtt_cth(residue: np.ndarray, dt: float) -> tuple[np.ndarray, np.ndarray]:
    """Integral of residues that are clipped at 0 and made to fall, and the spread of minus their slope; NaN where that has no area."""
    if residue.shape[1] < 5:
        return np.full(len(residue), np.nan), np.full(len(residue), np.nan)
    r = np.minimum.accumulate(np.maximum(residue, 0.0), axis=1)
    h = np.empty_like(r)
    h[:, 1:-1] = (r[:, :-2] - r[:, 2:]) / (2 * dt)
    h[:, 0] = (3 * r[:, 0] - 4 * r[:, 1] + r[:, 2]) / (2 * dt)
    h[:, -1] = (4 * r[:, -2] - r[:, -3] - 3 * r[:, -1]) / (2 * dt)
    h = np.maximum(h, 0.0)
    time = np.arange(r.shape[1]) * dt
    with np.errstate(all="ignore"):
        area = np.trapezoid(h, dx=dt, axis=1)
        ok = np.isfinite(area) & (area > 1e-12)
        h = h / area[:, None]
        mean = np.trapezoid(time * h, dx=dt, axis=1)
        cth = np.sqrt(np.maximum(np.trapezoid((time - mean[:, None]) ** 2 * h, dx=dt, axis=1), 0))
        return np.where(ok, np.trapezoid(r, dx=dt, axis=1), np.nan), np.where(ok, cth, np.nan)


def outflow_cth(residue: np.ndarray, flow: np.ndarray, peak: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Spread of the outflow of residues that start at their peak, lie in [0, 1], fall, and end in a ramp to 0; 0 without flow."""
    n = residue.shape[1]
    with np.errstate(all="ignore"):
        r = np.take_along_axis(residue, np.minimum(np.arange(n) + np.minimum(peak, n - 2)[:, None], n - 1), axis=1) / flow[:, None]
        first = np.where(np.isfinite(r[:, 0]) & (r[:, 0] > 0), r[:, 0], 1.0)
        r[:, 0] = first
        r = np.minimum.accumulate(np.clip(np.nan_to_num(r / first[:, None], nan=0.0), 0.0, 1.0), axis=1)
        r[:, n - 3 :] = r[:, n - 3, None] * np.array([1.0, 0.5, 0.0])
        h, middle = np.maximum(-np.diff(r, axis=1) / np.diff(t), 0.0), (t[:-1] + t[1:]) / 2
        area = np.trapezoid(h, middle, axis=1)
        h = h / area[:, None]
        mean = np.trapezoid(middle * h, middle, axis=1)
        spread = np.sqrt(np.maximum(np.trapezoid(middle**2 * h, middle, axis=1) - mean**2, 0))
    return np.where((flow > 0) & (area > 0), spread, 0.0)


def uniforms(seeds: np.ndarray, stream: int, n: int) -> np.ndarray:
    """n numbers in (0, 1) for each seed, by its counter and the stream alone: a mix of bits of (seed, stream, place)."""
    place = np.uint64(stream) * np.uint64(1 << 40) + np.arange(1, n + 1, dtype=np.uint64)
    x = (seeds.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))[:, None] + place * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def normals(seeds: np.ndarray, stream: int, n: int) -> np.ndarray:
    """n standard normal numbers for each seed: two of each pair of uniform ones."""
    half = -(-n // 2)
    radius, turn = np.sqrt(-2 * np.log(uniforms(seeds, stream, half))), 2 * np.pi * uniforms(seeds, stream + 1, half)
    return np.concatenate([radius * np.cos(turn), radius * np.sin(turn)], axis=1)[:, :n]


#: Numbers that posterior draws hold at once.
_DRAWN = 4 << 20


def _sampled_sd(o: dict, d: dict, beta: np.ndarray, misfit: np.ndarray, penalty: np.ndarray, log_evidence: np.ndarray | None, pick: np.ndarray, seeds: np.ndarray) -> dict[str, np.ndarray]:
    """Standard deviations of flow, transit time and spread over posterior draws of every curve, weights drawn by their evidence.

    The draws of a curve depend on its seed alone. Curves go in blocks of bounded size.
    """
    samples, frames = o["samples"], o["basis"].shape[1]
    names = ("cbf_sd", "mtt_sd", "cth_sd")
    out = {k: np.full(len(beta), np.nan) for k in names}
    step = max(1, _DRAWN // (samples * max(frames, beta.shape[1])))
    spread = d["back"].T @ o["basis"] / o["dt"]
    for at in range(0, len(beta), step):
        rows = slice(at, at + step)
        n = len(beta[rows])
        if log_evidence is None:
            draws = np.broadcast_to(pick[rows][:, None], (n, samples))
        else:
            p = np.cumsum(np.exp(log_evidence[rows] - log_evidence[rows].max(1, keepdims=True)), axis=1)
            level = uniforms(seeds[rows], 0, samples) * p[:, -1:]
            draws = np.stack([np.searchsorted(a, x) for a, x in zip(p, level)])
        each = np.arange(n)[:, None]
        sigma = np.sqrt(np.maximum(misfit[rows][each, draws] + o["w"][draws] ** 2 * penalty[rows][each, draws], 0) / len(o["t"]))
        noise = normals(seeds[rows], 1, samples * beta.shape[1]).reshape(n, samples, -1)
        den = d["den"][draws]
        z = ((d["c"] * beta[rows])[:, None, :] + sigma[:, :, None] * noise * np.sqrt(den)) / den
        residue = (z.reshape(n * samples, -1) @ spread).reshape(n, samples, frames)
        flow = residue[:, :, : o["flow_frames"]].max(2)
        flow = np.where(np.isfinite(flow) & (flow > 0), flow, np.nan)
        mtt, cth = residue_mtt_cth((residue / flow[:, :, None]).reshape(n * samples, frames), o["dt"])
        for k, x in zip(names, (flow * o["scale"], mtt.reshape(n, samples), cth.reshape(n, samples))):
            known = np.isfinite(x)
            count = np.maximum(known.sum(1), 1)
            mean = np.where(known, x, 0.0).sum(1) / count
            square = (np.where(known, x - mean[:, None], 0.0) ** 2).sum(1) / count
            out[k][rows] = np.where(known.any(1), np.sqrt(square), np.nan)
    return out


def kernel(values: np.ndarray, o: dict, carried: dict) -> dict[str, np.ndarray]:
    """One design a rounded delay; the weight of each curve by generalised cross-validation, the L-curve's corner or the evidence."""
    out = {k: np.full(len(values), np.nan) for k in ("cbf", "cbv", "mtt", "cth", "lambda_opt", "cbf_sd", "mtt_sd", "cth_sd")}
    delay = np.nan_to_num(carried.get("delay", np.zeros(len(values))))
    delay = np.round(delay / o["delay_step"]) * o["delay_step"]
    for at in np.unique(delay):
        if float(at) not in o["designs"]:
            o["designs"][float(at)] = _design(o["given"], o["t"], float(at), o["basis"], o["w"])
        rows = np.flatnonzero((delay == at) & np.isfinite(values).all(1))
        if len(rows):
            seeds = carried["seed"][rows].astype(np.int64) if "seed" in carried else np.zeros(len(rows), np.int64)
            for k, v in _solve(values[rows], o, o["designs"][float(at)], seeds).items():
                out[k][rows] = v
    return out


def _solve(c: np.ndarray, o: dict, d: dict, seeds: np.ndarray) -> dict[str, np.ndarray]:
    n, dt, w = len(o["t"]), o["dt"], o["w"]
    beta = c @ d["u"]
    b2 = beta**2
    rest = np.maximum((c**2).sum(1) - b2.sum(1), 0.0)
    misfit = rest[:, None] + b2 @ ((d["w2"] * d["s2"] / d["den"]) ** 2).T
    penalty = b2 @ (d["s2"] * d["c"] ** 2 / d["den"] ** 2).T
    log_evidence = None
    if o["selection"] == "evidence":
        log_evidence = -0.5 * n * np.log(np.maximum(misfit + w**2 * penalty, _TINY)) + d["rank"] * np.log(w) - 0.5 * d["log_det"]
        pick = log_evidence.argmax(1)
    elif o["selection"] == "gcv":
        pick = (misfit / np.maximum(d["freedom"], 1e-12) ** 2).argmin(1)
    else:
        pick = _corner(misfit, penalty, o["unit"])
    x = beta * d["c"] / d["den"][pick]
    residue = x @ d["back"].T @ o["basis"] / dt
    early = residue[:, : o["flow_frames"]]
    raw, peak = early.max(1), early.argmax(1)
    out = {"lambda_opt": w[pick]}
    if o["exact"]:
        flow = np.abs(raw)
        volume = np.abs(c.sum(1) / (d["c_a"].sum() or 1.0))
        top = residue[:, :10].max(1)
        r = np.where(top[:, None] > 0, residue / np.where(top > 0, top, 1.0)[:, None], 0.0)
        m0, m1 = r.sum(1) * dt, (o["t"] * r).sum(1) * dt
        out |= {"cth": np.where(top > 0, np.sqrt(np.maximum(2 * m1 - m0**2, 0)), 0.0), "mtt": np.where(raw > 0, volume / np.where(raw > 0, raw, 1.0), 0.0)}
    else:
        flow = np.maximum(raw, 0.0)
        volume = np.maximum(np.trapezoid(c, axis=1) / (np.trapezoid(d["c_a"]) or 1.0), 0.0)
        if o["moments"] == "residue_integral":
            mtt, cth = residue_mtt_cth(residue / flow[:, None], dt)
            out |= {"mtt": np.where(flow > 0, np.nan_to_num(mtt), 0.0), "cth": cth}
        else:
            out |= {"mtt": np.where(flow > 0, volume / np.where(flow > 0, flow, 1.0), 0.0), "cth": outflow_cth(residue, flow, peak, o["t"])}
    out |= {"cbf": flow * o["scale"], "cbv": volume * 100}
    rows = np.arange(len(c))
    if o["samples"]:
        out |= {k: np.where(flow > 0, v, np.nan) for k, v in _sampled_sd(o, d, beta, misfit, penalty, log_evidence, pick, seeds).items()}
    elif o["flow_sd"]:
        variance = np.maximum(misfit[rows, pick] + w[pick] ** 2 * penalty[rows, pick], 0) / n
        g = (o["basis"][:, peak] / dt).T @ d["back"]
        out["cbf_sd"] = np.where(flow > 0, o["scale"] * np.sqrt(variance * (g**2 / d["den"][pick]).sum(1)), np.nan)
    return out


register_model("deconvolve", Model(("cbf", "cbv", "mtt", "cth", "lambda_opt", "cbf_sd", "mtt_sd", "cth_sd"), prepare, kernel, carried=("delay", "seed"), options=_OPTIONS, batch=1024, drawn="samples"))
