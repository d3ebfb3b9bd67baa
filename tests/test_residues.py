"""Deconvolutions against residues whose flow, volume and spread are known."""

import numpy as np
import pytest

from curvemill.operators import deconvolution as D


def _bolus(t):
    u = np.maximum((t - 20) / 10, 0)
    return u**3 * np.exp(3 * (1 - u))


@pytest.mark.parametrize("mtt", [4.0, 8.0, 15.0])
def test_outflow_of_an_exponential_spreads_by_its_mean(mtt):
    t = np.arange(400) * 0.5
    residue = 0.01 * np.exp(-t / mtt)[None, :]
    spread = D.outflow_cth(residue, np.array([0.01]), np.array([0]), t)
    assert abs(spread[0] - mtt) < 0.02 * mtt
    assert D.outflow_cth(residue, np.array([0.0]), np.array([0]), t)[0] == 0


def test_exact_preset_keeps_the_volume_and_finds_the_flow():
    t = np.arange(120) * 2.0
    c_a, flow, mtt = _bolus(t), 0.01, 8.0
    tissue = D.convolution_matrix(c_a) @ (flow * np.exp(-t / mtt)) * 2.0
    found = D.kernel(tissue[None, :], D.prepare(c_a, t, **{**D._OPTIONS, "preset": "matlab"}), {})
    assert abs(found["cbv"][0] - 100 * tissue.sum() / c_a.sum()) < 1e-9
    assert abs(found["cbf"][0] / (6000 / 1.04) - flow) < 0.35 * flow
