"""Licences whose whole text is known by the first characters and the SHA-256 of its canonical form."""

from __future__ import annotations

# SPDX identifier -> (lead, digest) of ``licenses.whole_form`` of the published text and of its usual excerpts
WHOLE_DIGESTS = {
    "Apache-2.0": (
        ("apache licen", "4a6318c7afd8feed8c4463ea5ae0f2f609d433928a8b17f31104c8e7743de2c5"),
        ("terms and co", "1d0a3190e313c7276885cb69caa894144e6aa54cb9d65646350eceac54a7008a"),
        ("apache licen", "b93faad605f4e5d56d92cb01789c993887913c893e441b2305b4f880a9cead93"),
        ("terms and co", "fc9db7a0164e7200da89e02c3227560cc6bf5b50226261135c541f76ac8098f9"),
        ("apache licen", "4d82b1bff1ec74deb3a29bbe890a43fcd5d6d11ae4b24b20d2c0ef74a1b12809"),
        ("terms and co", "dd6b373e28950376ea177a601b11ba7f0238e579d5802f43e69921c313c82549"),
    ),
    "GPL-2.0": (
        ("gnu general ", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
        ("gnu general ", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
        ("gnu general ", "58f387b55eb95a9c5a6ef16e9064e1bfa9420a69181c677ee6eddf6ed1397cfd"),
        ("gnu general ", "b1abfb46077acd6c0450274e16fe4cb4610ec546c090c5977a069c5f74340774"),
        ("gnu general ", "1188bd946c8b086fe6ea384131bc5e4725728e74e0fe1902762c9c87ec4bd36a"),
        ("gnu general ", "ba8b5323b72bf2f2c5d07074133b38292e0fa23fde8fa48771ba8a04cccacddd"),
        ("gnu general ", "3f6302b11b06e2ba13b2ac80ac77a1979662ab69ce0b459e03a0238dd35d3518"),
        ("gnu general ", "2abe4f2f5ebff4aa8ed567a0cea0b9820cd074d9d7eda91d90df08701b51faa2"),
    ),
    "GPL-3.0": (
        ("gnu general ", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
        ("gnu general ", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ),
    "LGPL-3.0": (
        ("gnu lesser g", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ),
    "MPL-2.0": (
        ("mozilla publ", "4019e4c8fe9ede57c538b37b3332dc097a88c163e273bb6905d38316e63c2eb6"),
        ("1 definition", "f29410a4b9cf7ada059b5029550f39fe3cbfc5504fdab2a0b727735754430394"),
    ),
    "CC0-1.0": (
        ("creative com", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
        ("cc0 1 0 univ", "e91800afc6c48672fba71b29313951a2d91bd4f1e1d61ee386402d621dba7a0a"),
        ("cc0 1 0 univ", "51598576b1cb0fadab71e4daa2de0d02bf1003e59c3b8bd9319040afe0310780"),
        ("statement of", "bb878d68e2bd11ce5ffb0510fa88413b5dfd6d8fe1de780da66de6f74cf984af"),
        ("creative com", "b10619f02618297e24138b898e618895ec9618110a119ed5235b09dc25dd5746"),
    ),
    "Unlicense": (
        ("this is free", "fd1b07be5f4f94926b6ea4df3943b05ab90c1a1f3b1a3d574ae7ab58bca58fff"),
        ("this is free", "e6e60d2037efe58841d698b341a609d8a738effceaadb12ac721e54f8e0bf7db"),
        ("the unlicens", "d7ef23de23a66be0e3fdecee1f6bdf9f3d78ae8b5f45a1085c6bfae0eab283bd"),
    ),
    "CC-BY-4.0": (
        ("attribution ", "a37db6abfebdcf1a88f17ff1fdf86f19ab1f0aab8d23838bd00ef30bdfade752"),
        ("creative com", "4af66050f22b07782cda9ad4b6ffe1004eedd2ee517c323d4a206f1e42d18b92"),
        ("attribution ", "e369f255722d060987e85d83cf9eb8dc0e6b06cd6df7eaef86f02209b84d46e2"),
        ("creative com", "b239050357aa90bf8837fbf4d79617dc16cc061f7aaa512ed91b9320b8a46d0d"),
        ("creative com", "20c516f6d990b8d7c7a15ec63c65a3d4303cc6c1476f36143fca235ce26473a6"),
    ),
    "CC-BY-SA-4.0": (
        ("creative com", "c1fbc3f0a2616b03054c52e6e6625f5b3d40f82580f71926feb698f68a793db4"),
        ("creative com", "2a5a6a6e80fb7efe409b384e4b953f9c243db7d2dc9c48e9056945d17026169a"),
        ("creative com", "b140719daf199a660b35499b18ecfaafdb0b64db2f53790b9da29e55b708a722"),
        ("creative com", "21242be62da799d01a3f33132228b7e48fb324156803dc6859ef14613325cfd9"),
        ("attribution ", "2cc7d162b829c0e700a104333e8201273802f0e394325b408659e8b41fdc8964"),
        ("creative com", "94d3c27224afc174aed47114f9f7102f02080273ccdf98d5029993c239983d16"),
        ("attribution ", "a047ad28d5b35d5466e305b67e3747795557531a4b504871fef1b547b299c09a"),
    ),
}
